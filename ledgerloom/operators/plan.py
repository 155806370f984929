"""Arithmetic plans over cells: lookups, extrema, reductions and a whitelisted expression compiler."""

from __future__ import annotations

import ast
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from .normalize import unit_scale

# Fixed values.
REDUCTIONS = ("sum", "avg", "max", "min", "count_gt", "count_ge", "count_lt", "count_le")
NO_VALUE_HEADERS = ("mã số", "thuyết minh", "note", "biến động", "%")
NARRATIVE = ("giải trình", "thuyết minh", "explan")
MAX_WORDS, MIN_WORDS = ("cao nhất", "lớn nhất"), ("thấp nhất", "nhỏ nhất")
WHICH_YEAR = ("năm nào", "kỳ nào", "thời điểm nào")


class PlanError(ValueError):
    """An expression or plan outside the whitelist."""


def checked(expression: str, aliases: set[str]) -> ast.expr:
    """Syntax tree of an expression of names, numbers, + - * / **, unary signs and abs(); PlanError otherwise."""
    try:
        root = ast.parse(expression, mode="eval").body
    except SyntaxError as e:
        raise PlanError(f"not an expression: {e.msg}") from e
    todo = [root]
    while todo:
        n = todo.pop()
        match n:
            case ast.Name():
                if n.id not in aliases:
                    raise PlanError(f"unknown name {n.id}")
            case ast.Constant(value=v) if isinstance(v, (int, float)) and not isinstance(v, bool):
                pass
            case ast.BinOp(op=ast.Add() | ast.Sub() | ast.Mult() | ast.Div() | ast.Pow()):
                todo += [n.left, n.right]
            case ast.UnaryOp(op=ast.UAdd() | ast.USub()):
                todo.append(n.operand)
            case ast.Call(func=ast.Name(id="abs"), args=[arg], keywords=[]):
                todo.append(arg)
            case _:
                raise PlanError(f"{type(n).__name__} isn't allowed")
    return root


def compiled(expression: str, columns: Mapping[str, Column]) -> Column:
    """The expression as a DOUBLE column; division by zero and results that aren't finite are null."""

    def build(n: ast.expr) -> Column:
        match n:
            case ast.Name():
                return columns[n.id].cast("double")
            case ast.Constant():
                return F.lit(float(n.value))
            case ast.UnaryOp(op=ast.USub()):
                return -build(n.operand)
            case ast.UnaryOp():
                return build(n.operand)
            case ast.Call():
                return F.abs(build(n.args[0]))
        a, b = build(n.left), build(n.right)
        match n.op:
            case ast.Add():
                return a + b
            case ast.Sub():
                return a - b
            case ast.Mult():
                return a * b
            case ast.Div():
                return F.try_divide(a, b)
            case _:
                return F.pow(a, b)

    value = build(checked(expression, set(columns)))
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def reduced(cells: DataFrame, reductions: list[tuple], by: list[str], value: str = "value") -> DataFrame:
    """Reductions (alias, op, threshold, [column]) per group in one aggregate; an average of nothing is 0, null cells don't count."""
    aggs = []
    for alias, op, limit, *other in reductions:
        v = F.col(*(other or [value]))
        if op not in REDUCTIONS:
            raise PlanError(f"unknown reduction {op}")
        if op.startswith("count_"):
            if limit is None:
                raise PlanError(f"{op} needs a threshold")
            test = {"gt": v > limit, "ge": v >= limit, "lt": v < limit, "le": v <= limit}[op[6:]]
            aggs.append(F.count_if(test).cast("double").alias(alias))
        elif op == "avg":
            aggs.append(F.coalesce(F.avg(v), F.lit(0.0)).alias(alias))
        elif op == "sum":
            aggs.append(F.coalesce(F.sum(v), F.lit(0.0)).alias(alias))
        else:
            aggs.append(getattr(F, op)(v).alias(alias))
    return cells.groupBy(*by).agg(*aggs)


def extremum(question: Column, asked_years: Column) -> Column:
    """Struct (direction, mode) of a question for the largest or smallest over two years or more, else null."""
    q = F.lower(F.coalesce(question, F.lit("")))
    said = lambda words: F.greatest(*[q.contains(w) for w in words])
    direction = F.when(said(MAX_WORDS), "max").when(said(MIN_WORDS), "min")
    mode = F.when(said(WHICH_YEAR), "year").otherwise("value")
    return F.when(direction.isNotNull() & (F.size(asked_years) >= 2), F.struct(direction.alias("direction"), mode.alias("mode")))


def structural(ops: DataFrame) -> DataFrame:
    """Operands that can be an amount: below and right of the first row and column, under a header that isn't a code, note or change."""
    h = F.lower("column_header")
    return ops.filter((F.col("row_index") > 0) & (F.col("column_index") > 0) & (F.trim(h) != "") & ~F.greatest(*[h.contains(w) for w in NO_VALUE_HEADERS]))


def prefer(df: DataFrame, test: Column, by: str = "id") -> DataFrame:
    """Keeps rows that pass where any row of the group does, else all rows of the group."""
    n = F.count_if(test).over(Window.partitionBy(by))
    return df.withColumn("_ok", F.coalesce(test, F.lit(False))).withColumn("_n", n).filter(F.col("_ok") | (F.col("_n") == 0)).drop("_ok", "_n")


def direct_lookup(ops: DataFrame, questions: DataFrame) -> DataFrame:
    """The one operand that answers each lookup question: (id, table_key, row_index, column_index, numeric_value).

    ops: operands with year, table_identity, asked_years. A year that is named must be the table's or in
    the header; opening or closing balance is preferred where headers or labels tell them apart. The
    largest weighted score wins, ties by the larger table key, then the earlier row and column.
    """
    o = structural(ops).join(questions.select("id", F.lower("question").alias("q")), "id")
    in_year = F.coalesce(F.array_contains("asked_years", F.col("year")), F.lit(False))
    in_head = F.exists("asked_years", lambda y: F.col("column_header").contains(y.cast("string")))
    o = o.filter((F.size("asked_years") == 0) | in_year | in_head)
    where = F.lower(F.concat_ws(" ", "row_label", "column_header"))
    period = F.when(F.col("q").contains("cuối năm"), "cuối năm").when(F.col("q").contains("đầu năm"), "đầu năm")
    o = prefer(o, period.isNotNull() & where.contains(period))
    identity = F.lower(F.coalesce("table_identity", F.lit("")))
    weight = (
        F.col("score") * 100
        + F.when(in_year, 20.0).otherwise(0.0)
        + F.when(in_year & F.lower("column_header").contains("năm nay"), 10.0).otherwise(0.0)
        - F.when(F.greatest(*[identity.contains(w) for w in NARRATIVE]), 25.0).otherwise(0.0)
    )
    w = Window.partitionBy("id").orderBy(F.desc(F.round(weight, 6)), F.desc("table_key"), "row_index", "column_index")
    return o.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("id", "table_key", "row_index", "column_index", "numeric_value", "column_header")


def extremum_year(ops: DataFrame) -> DataFrame:
    """Best operand per named year, then the largest and smallest value over the years (the earlier year on ties)."""
    o = structural(ops).withColumn("asked", F.explode("asked_years"))
    o = o.filter((F.col("year") == F.col("asked")) | F.col("column_header").contains(F.col("asked").cast("string")))
    w = Window.partitionBy("id", "asked").orderBy(F.desc("score"), F.desc("table_key"), "row_index", "column_index")
    best = o.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    return best.groupBy("id").agg(
        F.max_by("asked", F.struct("numeric_value", -F.col("asked"))).alias("max_year"), F.max("numeric_value").alias("max_value"),
        F.min_by("asked", F.struct("numeric_value", "asked")).alias("min_year"), F.min("numeric_value").alias("min_value"), F.count("*").alias("n_years"),
    )


def scale_factor(source_unit: Column, target_unit: Column) -> Column:
    """Factor from source to target unit; 1 where neither is known, null where only the target is."""
    s, t = unit_scale(source_unit), unit_scale(target_unit)
    return F.when(t.isNull(), F.lit(1.0)).otherwise(s / t)


def coordinate_errors(plans: DataFrame, allowed: DataFrame) -> DataFrame:
    """Operands (id, alias, table_key, row_index, column_index) of plans that break a rule: alias used twice, no identifier, or a cell that isn't allowed."""
    keys = ["id", "table_key", "row_index", "column_index"]
    twice = plans.groupBy("id", "alias").agg(F.count("*").alias("n")).filter("n > 1").select("id", "alias", F.lit("duplicate alias").alias("error"))
    odd = plans.filter(~F.col("alias").rlike("^[A-Za-z_][A-Za-z0-9_]*$")).select("id", "alias", F.lit("not an identifier").alias("error"))
    outside = plans.join(allowed.select(*keys).distinct(), keys, "left_anti").select("id", "alias", F.lit("cell not allowed").alias("error"))
    return twice.unionByName(odd).unionByName(outside).distinct()
