"""Plans written by a text model: prompt, budget, reading, validation and evaluation for one question at a time.

The model is a callable from prompt to text that the caller supplies; nothing is evaluated as code.
"""

from __future__ import annotations

import ast
import json
import re
import unicodedata
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from .index import STOP_WORDS
from .plan import REDUCTIONS, PlanError, checked

Cell = tuple[str, int, int]


class Fact(NamedTuple):
    """What is known of a cell that a plan may use."""

    label: str
    header: str
    value: float
    ticker: str | None = None
    year: int | None = None
    variant: str | None = None


class Asked(NamedTuple):
    """What a question demands of a plan: years, report variant, companies that must be covered, several cells."""

    years: frozenset[int] = frozenset()
    variant: str | None = None
    tickers: frozenset[str] = frozenset()
    several: bool = False


#: Categories of what is wrong with a plan, by words of the error.
ERRORS = {
    "is incomplete": "incomplete_operand_group", "outside the cells shown": "invented_or_unresolved_operand", "unknown reduction": "unknown_reduction_op", "needs a threshold": "reduction_missing_threshold",
    "unknown group": "reduction_references_unknown_group", "twice": "duplicate_names", "is empty": "empty_group", "an empty plan": "empty_plan", "isn't an identifier": "alias_collision",
    "needs several cells": "too_few_operands", "lacks required companies": "missing_companies", "JSON": "not_json",
}


def error_category(message: Column) -> Column:
    """Category of an error message, null for none and for messages of another kind."""
    out = F.lit(None).cast("string")
    for words, name in reversed(ERRORS.items()):
        out = F.when(message.contains(words), name).otherwise(out)
    return out


def group_errors(name: str, metric: str, cells: list[Fact], asked: Asked) -> list[str]:
    """What a group of operands lacks: cells of another year or variant than asked, companies, rows that name the metric."""
    wrong = []
    for f in cells:
        if asked.years and f.year not in asked.years and not any(str(y) in f.header for y in asked.years):
            wrong.append("a cell of another period")
        if asked.variant and f.variant not in (None, "", "unspecified", asked.variant):
            wrong.append("a cell of another report variant")
    missing = asked.tickers - {f.ticker for f in cells}
    if missing:
        wrong.append(f"no cell of {', '.join(sorted(missing))}")
    words = lambda s: {w for w in re.findall(r"\w+", unicodedata.normalize("NFC", s).lower()) if w not in STOP_WORDS}
    metric_words = words(metric)
    if metric_words and any((own := words(f.label)) and not own & metric_words for f in cells):
        wrong.append(f"a row that doesn't name {metric}")
    return [f"group {name}: {w}" for w in dict.fromkeys(wrong)]


#: Letters of a label and a header that a prompt shows; a longer one ends in an ellipsis. Plans refer to cells by place, so nothing else is lost.
LABEL, HEADER = 160, 80


def within_budget(ops: DataFrame, size: str, budget: int, most: int = 32) -> DataFrame:
    """The longest prefix of each question's operands (by pos) whose sizes add up to the budget, most of them at most."""
    run = F.sum(size).over(Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return ops.withColumn("_run", run).filter((F.col("_run") <= budget) & (F.col("pos") <= most)).drop("_run")


def prompt(question: str, cells: Mapping[Cell, tuple], feedback: str = "") -> str:
    """The task, the cells that may be used (label, header, value) and what was wrong before."""
    short = lambda s, most: s if len(s) <= most else s[: most - 1] + "…"
    listed = [{"table_key": k[0], "row_index": k[1], "column_index": k[2], "label": short(v[0], LABEL), "header": short(v[1], HEADER), "value": v[2]} for k, v in cells.items()]
    lines = [
        "Answer with one JSON object: operands [{alias, table_key, row_index, column_index}], groups [{name, operands}],",
        "reductions [{alias, op, group, threshold}], expression over the aliases with + - * / ** and abs().",
        f"Question: {question}",
        "Cells: " + json.dumps(listed, ensure_ascii=False),
    ]
    return "\n".join(lines + ([f"The last plan was refused: {feedback}"] if feedback else []))


def read_plan(text: str) -> dict:
    """The object between the first opening and the last closing brace of a text."""
    a, b = text.find("{"), text.rfind("}")
    if a < 0 or b < a:
        raise PlanError("no JSON object")
    try:
        plan = json.loads(text[a : b + 1])
    except ValueError as e:
        raise PlanError(f"not JSON: {e}") from e
    if not isinstance(plan, dict):
        raise PlanError("not an object")
    return plan


def _bound(items: object, cells: Mapping[Cell, tuple]) -> list[tuple[str, float]]:
    out = []
    for o in items if isinstance(items, list) else []:
        try:
            alias, key = str(o["alias"]), (str(o["table_key"]), int(o["row_index"]), int(o["column_index"]))
        except (KeyError, TypeError, ValueError) as e:
            raise PlanError("an operand lacks a field") from e
        if not alias.isidentifier():
            raise PlanError(f"{alias} isn't an identifier")
        if key not in cells:
            raise PlanError(f"{alias} is outside the cells shown")
        out.append((alias, cells[key][2]))
    return out


def evaluate(plan: dict, cells: Mapping[Cell, tuple], several: bool = False, asked: Asked = Asked()) -> float:
    """Value of a plan over the cells; PlanError names the first rule it breaks. Division by zero and overflow break it too.

    asked: groups must fit its years, variant and companies, and all bound cells together cover its companies.
    """
    operands = _bound(plan.get("operands"), cells)
    groups: dict[str, list[tuple[str, float]]] = {}
    for g in plan.get("groups") or []:
        if not isinstance(g, dict):
            raise PlanError("a group is no object")
        name = str(g.get("name"))
        if name in groups:
            raise PlanError(f"group {name} twice")
        groups[name] = _bound(g.get("operands"), cells)
        if not groups[name]:
            raise PlanError(f"group {name} is empty")
    named = operands + [o for g in groups.values() for o in g]
    if not named:
        raise PlanError("an empty plan")
    values = dict(named)
    reductions = plan.get("reductions") or []
    aliases = [a for a, _ in named] + [str(r.get("alias")) for r in reductions]
    if len(set(aliases)) < len(aliases):
        raise PlanError("an alias twice")
    for r in reductions:
        op, group, limit = r.get("op"), str(r.get("group")), r.get("threshold")
        if op not in REDUCTIONS:
            raise PlanError(f"unknown reduction {op}")
        if group not in groups:
            raise PlanError(f"unknown group {group}")
        v = [x for _, x in groups[group]]
        if op.startswith("count_"):
            if not isinstance(limit, (int, float)) or isinstance(limit, bool):
                raise PlanError(f"{op} needs a threshold")
            test = {"gt": float.__gt__, "ge": float.__ge__, "lt": float.__lt__, "le": float.__le__}[op[6:]]
            values[str(r["alias"])] = float(sum(test(float(x), float(limit)) for x in v))
        else:
            values[str(r["alias"])] = {"sum": sum(v), "avg": sum(v) / len(v), "max": max(v), "min": min(v)}[op]
    incomplete = [e for g in plan.get("groups") or [] for e in group_errors(str(g.get("name")), str(g.get("metric_label") or ""), [Fact(*cells[k]) for k in _keys(g.get("operands"))], asked)]
    if incomplete:
        raise PlanError("a group is incomplete: " + "; ".join(incomplete))
    covered = {Fact(*cells[k]).ticker for k in used_cells(plan)}
    if asked.tickers - covered:
        raise PlanError(f"the plan lacks required companies: {', '.join(sorted(asked.tickers - covered))}")
    if (several or asked.several) and len(named) < 2:
        raise PlanError("the question needs several cells")
    return _value(checked(str(plan.get("expression", "")), set(values)), values)


def _keys(items: object) -> list[Cell]:
    return [(str(o["table_key"]), int(o["row_index"]), int(o["column_index"])) for o in (items if isinstance(items, list) else [])]


def used_cells(plan: dict) -> list[Cell]:
    """Cells a plan binds, operands first, then its groups', each once."""
    return list(dict.fromkeys([*_keys(plan.get("operands")), *(k for g in plan.get("groups") or [] for k in _keys(g.get("operands")))]))


def _value(n: ast.expr, values: Mapping[str, float]) -> float:
    try:
        match n:
            case ast.Name():
                x = float(values[n.id])
            case ast.Constant():
                x = float(n.value)
            case ast.UnaryOp(op=ast.USub()):
                x = -_value(n.operand, values)
            case ast.UnaryOp():
                x = _value(n.operand, values)
            case ast.Call():
                x = abs(_value(n.args[0], values))
            case _:
                a, b = _value(n.left, values), _value(n.right, values)
                match n.op:
                    case ast.Add():
                        x = a + b
                    case ast.Sub():
                        x = a - b
                    case ast.Mult():
                        x = a * b
                    case ast.Div():
                        x = a / b
                    case _:
                        x = a**b
    except (ZeroDivisionError, OverflowError) as e:
        raise PlanError(f"can't be computed: {e}") from e
    if isinstance(x, complex) or x != x or abs(x) == float("inf"):
        raise PlanError("not a finite number")
    return x


@dataclass
class Answer:
    """value is null where every attempt failed; errors holds what was wrong with each."""

    value: float | None = None
    errors: list[str] = field(default_factory=list)
    expression: str | None = None
    cells: list[Cell] = field(default_factory=list)


def answer(question: str, cells: Mapping[Cell, tuple], complete: Callable[[str], str], retries: int = 2, several: bool = False, asked: Asked = Asked()) -> Answer:
    """Ask, read, check and evaluate; what was wrong goes into the next prompt. Running out of memory ends the attempts."""
    out = Answer()
    for _ in range(retries + 1):
        try:
            plan = read_plan(complete(prompt(question, cells, out.errors[-1] if out.errors else "")))
            out.value = evaluate(plan, cells, several, asked)
            out.expression, out.cells = str(plan.get("expression", "")), used_cells(plan)
            return out
        except MemoryError as e:
            out.errors.append(f"out of memory: {e}")
            return out
        except PlanError as e:
            out.errors.append(str(e))
    return out
