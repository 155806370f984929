"""Answer packages: assembled records, checks as error rows, merging with precedence."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import number
from .metrics import close
from .plan import PlanError, checked


def split_key(key: Column) -> tuple[Column, Column]:
    """Report id and line position of a table key, split at its last bar."""
    return F.regexp_extract(key, r"^(.*)\|[^|]*$", 1), F.regexp_extract(key, r"\|([^|]*)$", 1).try_cast("int")


def table_cells(tables: DataFrame) -> DataFrame:
    """Long form of grids: table_key, row_index, column_index, text, numeric_value."""
    rows = tables.filter(F.size("grid") > 0).select("table_key", F.posexplode("grid").alias("row_index", "row"))
    return rows.select("table_key", "row_index", F.posexplode("row").alias("column_index", "text")).withColumn("numeric_value", number(F.col("text")))


def evidence(cells: DataFrame, used: DataFrame) -> DataFrame:
    """Long form of the cells of the tables each answer uses: id, table_key, row_index, column_index, text, numeric_value."""
    return used.select("id", "table_key").distinct().join(cells, "table_key")


def assembled(questions: DataFrame, answers: DataFrame, tables: DataFrame) -> DataFrame:
    """One record per question: id, question, answer, relevant_tables and relevant_docs in rank order, each once.

    answers: id, answer. tables: id, table_key, rank. Questions without an answer have null and no tables.
    """
    docs = tables.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "table_key"))), lambda s: s["table_key"]).alias("relevant_tables"))
    docs = docs.withColumn("relevant_docs", F.array_distinct(F.transform("relevant_tables", lambda k: split_key(k)[0])))
    none = F.array().cast("array<string>")
    j = questions.select("id", "question").dropDuplicates(["id"]).join(answers.select("id", "answer").dropDuplicates(["id"]), "id", "left").join(docs, "id", "left")
    return j.withColumns({c: F.coalesce(c, none) for c in ("relevant_tables", "relevant_docs")})


def check(package: DataFrame, questions: DataFrame, recomputed: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(id, error) rows of a package against its questions and a second evaluation; none for a sound one.

    Errors: duplicate id, unknown id, missing, question differs, not finite, docs differ, answer differs.
    """
    error = lambda df, text: df.select("id", F.lit(text).alias("error"))
    q = questions.select("id", F.col("question").alias("asked")).dropDuplicates(["id"])
    p = package.join(q, "id", "left").join(recomputed.select("id", F.col("answer").alias("again")), "id", "left")
    docs = F.array_distinct(F.transform("relevant_tables", lambda k: split_key(k)[0]))
    a = F.col("answer")
    rows = [
        error(package.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1"), "duplicate id"),
        error(p.filter("asked is null"), "unknown id"),
        error(q.join(package.select("id"), "id", "left_anti"), "missing"),
        error(p.filter("asked is not null and not (question <=> asked)"), "question differs"),
        error(p.filter(a.isNull() | F.isnan(a) | (F.abs(a) == float("inf"))), "not finite"),
        error(p.filter(~F.col("relevant_docs").eqNullSafe(docs)), "docs differ"),
        error(p.filter(a.isNotNull() & F.col("again").isNotNull() & ~close(a, F.col("again"), tolerance, tolerance)), "answer differs"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.distinct()


def refusals(questions: DataFrame, predictions: DataFrame, allow_partial: bool = False) -> DataFrame:
    """(id, error) of questions that a package can't hold: no prediction, not executed, another question text, no finite number.

    allow_partial lets the first two pass, which only leave the question out; the others are always errors.
    """
    q = questions.select("id", F.col("question").alias("asked")).dropDuplicates(["id"])
    j = q.join(predictions.dropDuplicates(["id"]).select("id", "question", "answer", "executed", F.lit(True).alias("_there")), "id", "left")
    a = F.col("answer")
    error = F.when(F.col("_there").isNull(), "missing prediction").when(~F.coalesce("executed", F.lit(False)), "not executed").when(~F.col("question").eqNullSafe(F.col("asked")), "question differs")
    error = F.coalesce(error, F.when(a.isNull() | F.isnan(a) | (F.abs(a) == float("inf")), "not finite"))
    out = j.select("id", error.alias("error")).filter("error is not null")
    return out.filter(~F.col("error").isin("missing prediction", "not executed")) if allow_partial else out


#: Names that a rendered expression may bind.
VARIABLE = r"^[A-Za-z_][A-Za-z0-9_]*$"


def check_records(package: DataFrame) -> DataFrame:
    """(id, error) of records that are wrong by themselves; none for a sound one.

    package: id, relevant_tables, relevant_docs, evidence (array of struct variable, path), query. Errors: no tables, no
    documents, documents twice, a table key of another form, documents of another order than the tables, no evidence, a
    variable that is no identifier or stands twice, a path outside data/, variables that the query and the evidence don't
    share, a query that isn't allowed.
    """
    docs = F.array_distinct(F.transform("relevant_tables", lambda k: split_key(k)[0]))
    bad_key = F.exists("relevant_tables", lambda k: ~F.coalesce(k.rlike(r"^.+\|[0-9]+$"), F.lit(False)))
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    names, paths = F.transform("evidence", lambda e: e["variable"]), F.transform("evidence", lambda e: e["path"])
    inside = lambda p: p.startswith("data/") & ~F.array_contains(F.split(p, "/"), "..")
    tests = {
        "no tables": empty("relevant_tables"), "no documents": empty("relevant_docs"), "documents twice": F.size(F.array_distinct("relevant_docs")) < F.size("relevant_docs"), "bad table key": bad_key,
        "documents differ": ~F.col("relevant_docs").eqNullSafe(docs), "no evidence": empty("evidence"), "bad variable": F.exists(names, lambda v: ~F.coalesce(v.rlike(VARIABLE), F.lit(False))),
        "variable twice": F.size(F.array_distinct(names)) < F.size(names), "path outside data": F.exists(paths, lambda p: ~F.coalesce(inside(p), F.lit(False))),
    }
    found = package.select("id", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), n) for n, t in tests.items()]))).alias("error"))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for i, query, evidence in zip(pdf["id"], pdf["query"], pdf["evidence"]):
                declared = {e["variable"] for e in (evidence if evidence is not None else [])}
                try:
                    used = query_names(query or "")
                except PlanError:
                    rows.append((i, "query not allowed"))
                    continue
                if used != declared:
                    rows.append((i, "variables differ"))
            yield pd.DataFrame(rows, columns=["id", "error"])

    kind = package.schema["id"].dataType.simpleString()
    return found.unionByName(package.select("id", "query", "evidence").mapInPandas(run, f"id {kind}, error string"))


_REFERENCE = re.compile(r"cell\(\s*([A-Za-z_][A-Za-z0-9_]*)\s*,\s*(\d+)\s*,\s*(\d+)\s*\)")


def query_names(query: str) -> set[str]:
    """Variables of a rendered query: an arithmetic expression over cell(variable, row, column); PlanError for anything else."""
    names = {m[1] for m in _REFERENCE.finditer(query)}
    checked(_REFERENCE.sub("1", query), set())
    return names


def rendered(expression: Column, cells: Column, tables: Column) -> Column:
    """A lookup's expression over x with x as cell(variable, row, column); variables are t1, t2, ... by place in tables."""
    c = F.get(cells, F.lit(0))
    at = F.concat(F.lit("cell(t"), F.array_position(tables, c["table_key"]).cast("string"), F.lit(", "), c["row_index"].cast("string"), F.lit(", "), c["column_index"].cast("string"), F.lit(")"))
    return F.regexp_replace(expression, r"\bx\b", at)


def merged(preferred: DataFrame, other: DataFrame, key: str = "id") -> DataFrame:
    """Rows of preferred, and of other for keys preferred lacks; origin tells preferred, both or other."""
    kept = preferred.join(other.select(key, F.lit(True).alias("_o")).dropDuplicates([key]), key, "left")
    kept = kept.withColumn("origin", F.when(F.col("_o"), "both").otherwise("preferred")).drop("_o")
    rest = other.join(preferred.select(key), key, "left_anti").withColumn("origin", F.lit("other"))
    return kept.unionByName(rest, allowMissingColumns=True)
