"""Questions grounded and answered without a model: entity scope, hard filters, lookups, extrema, units, and the route of each question.

All questions are worked on at once; what goes wrong with one is a reason in its row, never an exception.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import composed, tokens
from ..session import join_checked, settle
from . import link as L, plan as P
from .normalize import column_metadata, unit_scale
from .scope import code_words, variant, years

# Fixed values.
PARENT_WORDS, GROUP_WORDS = ("công ty mẹ", "công ty riêng"), ("hợp nhất", "tập đoàn")
CLOSING, OPENING = "cuối năm", "đầu năm"
MODEL_OPERANDS = 32
#: Reasons why a question has no answer, in the order in which they are looked for.
REASONS = ("no operand of the named company", "no operand fits", "no operand of the asked year", "no operand of the asked period", "no unambiguous source unit")


def available_tickers(pairs: DataFrame, tables: DataFrame) -> DataFrame:
    """(id, available): companies of the tables retrieved for each question; at most as many as its tables."""
    t = tables.select("table_key", "ticker").filter("ticker is not null")
    return pairs.select("id", "table_key").distinct().join(t, "table_key").groupBy("id").agg(F.array_sort(F.collect_set("ticker")).alias("available"))


def precise_tickers(questions: DataFrame, available: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, tickers): codes a question spells out that its tables have; a code that is a word of exactly one other available company's name stands for that company."""
    named = join_checked(available.select("id", F.explode("available").alias("ticker")), companies.select("ticker", "name").dropDuplicates(["ticker"]), "ticker", "left", 120)
    words = F.array_distinct(tokens(composed(F.coalesce("name", F.lit(""))), L.LINK_STOP))
    per = named.groupBy("id").agg(F.collect_list(F.struct("ticker", words.alias("words"))).alias("av"))
    codes = F.filter(code_words(F.col("question")), lambda t: ~t.isin(*L.NOT_TICKERS))
    j = questions.select("id", "question").dropDuplicates(["id"]).join(per, "id", "left").withColumn("codes", codes)
    spelled = F.filter("codes", lambda c: F.exists("av", lambda a: a["ticker"] == c))

    def meant(code: Column) -> Column:
        inside = F.filter("av", lambda a: (a["ticker"] != code) & F.array_contains(a["words"], F.lower(code)))
        return F.when(F.size(inside) == 1, F.get(inside, F.lit(0))["ticker"]).otherwise(code)

    none = F.array().cast("array<string>")
    return j.select("id", F.when(F.col("av").isNull(), none).otherwise(F.array_sort(F.array_distinct(F.transform(spelled, meant)))).alias("tickers"))


def column_scales(grid: Column, stored: Column, detected: Column) -> Column:
    """VND per unit of each column: by its own header cells, else the stored metadata, else the first row's text, else the table's units if they agree."""
    by_column = F.map_from_entries(F.array_distinct(F.transform(F.filter(stored, lambda m: m["column_index"].isNotNull()), lambda m: F.struct(m["column_index"], m["scale_to_vnd"]))))
    known = F.array_distinct(F.filter(F.transform(detected, lambda u: unit_scale(u)), lambda s: s.isNotNull()))
    agreed = F.when(F.size(known) == 1, F.get(known, F.lit(0)))
    first = F.get(grid, F.lit(0))
    return F.transform(column_metadata(grid, F.lit(None).cast("string")), lambda m: F.coalesce(m["scale_to_vnd"], F.try_element_at(by_column, m["column_index"]), unit_scale(F.get(first, m["column_index"])), agreed))


def with_scales(ops: DataFrame, tables: DataFrame) -> DataFrame:
    """ops plus source_scale: VND per unit of their column, null where nothing says it without doubt."""
    none = lambda c: F.array().cast(tables.schema[c].dataType)
    stored, detected = (F.coalesce(c, none(c)) for c in ("column_metadata", "detected_units"))
    wanted = tables.filter(F.size("grid") > 0).join(ops.select("table_key").distinct(), "table_key", "left_semi")
    scales = wanted.select("table_key", F.posexplode(column_scales(F.col("grid"), stored, detected)).alias("column_index", "source_scale"))
    return ops.join(scales, ["table_key", "column_index"], "left")


def candidates(ops: DataFrame, asked: DataFrame) -> DataFrame:
    """ops (ordered operands with ticker, variant) of each asked question with flags ok_company and ok_shape.

    asked: id, question, tickers. A company that is named and a report variant that is asked for are hard filters; row 0,
    column 0, empty headers and headers of codes, notes and changes hold no amount.
    """
    o = ops.join(asked.select("id", "tickers", F.lower("question").alias("q")), "id")
    said = lambda words: F.greatest(*[F.col("q").contains(w) for w in words])
    of = F.when(said(PARENT_WORDS), "separate").when(said(GROUP_WORDS), "consolidated")
    head = F.lower("column_header")
    shape = (F.col("row_index") > 0) & (F.col("column_index") > 0) & (F.trim("column_header") != "") & ~F.greatest(*[head.contains(w) for w in P.NO_VALUE_HEADERS])
    company = (F.size("tickers") == 0) | F.coalesce(F.array_contains("tickers", F.col("ticker")), F.lit(False))
    return o.withColumn("ok_company", company).withColumn("ok_shape", company & (of.isNull() | of.eqNullSafe(F.col("variant"))) & shape)


def _unit_answer(value: Column, source: Column, unit: Column) -> tuple[Column, Column, Column]:
    """(factor, answer, whether the source unit is missing) of a value in a unit asked for."""
    target = unit_scale(unit)
    factor = F.when(target.isNull() | source.isNull(), F.lit(1.0)).otherwise(source / target)
    return factor, value * factor, source.isNull() & target.isNotNull()


def lookups(ops: DataFrame, asked: DataFrame, ignore_unit: bool = False) -> DataFrame:
    """The one cell that answers each question of asked: id, table_key, row_index, column_index, numeric_value, factor, answer, unit, reason.

    ops: ordered operands with source_scale. A year that is named must be the table's or in the header; opening or closing
    balance decides where headers or labels tell them apart. The largest weight wins, then the larger table key, the earlier
    row and column. Without an answer the reason says which filter left nothing. ignore_unit: the value stays in the unit of
    its column where that isn't known, and closing or opening isn't asked for.
    """
    o = candidates(ops, asked)
    named = F.array_distinct(F.regexp_extract_all("q", F.lit(r"\b(20[0-9]{2})\b"), 1))
    in_year = F.coalesce(F.array_contains(named, F.col("year").cast("string")), F.lit(False))
    in_head = F.exists(named, lambda y: F.col("column_header").contains(y))
    where = F.lower(F.concat_ws(" ", "row_label", "column_header"))
    period = F.when(F.col("q").contains(CLOSING), CLOSING).when(F.col("q").contains(OPENING), OPENING)
    o = o.withColumn("ok_year", F.col("ok_shape") & ((F.size(named) == 0) | in_year | in_head))
    # In a fallback another year is better than none.
    some = F.max("ok_year").over(Window.partitionBy("id"))
    o = o.withColumn("ok_year", F.when(F.lit(ignore_unit) & ~some, F.col("ok_shape")).otherwise(F.col("ok_year")))
    told, fits = where.contains(CLOSING) | where.contains(OPENING), where.contains(period)
    o = o.withColumn("told", F.col("ok_year") & period.isNotNull() & told & F.lit(not ignore_unit)).withColumn("fits", F.col("ok_year") & F.coalesce(fits, F.lit(False)) & F.lit(not ignore_unit))
    by = Window.partitionBy("id")
    o = o.withColumn("ok", F.when(F.max("told").over(by), F.col("fits")).otherwise(F.col("ok_year")))
    identity = F.lower(F.coalesce("table_identity", F.lit("")))
    weight = (
        F.col("score") * 100 + F.when(in_year, 20.0).otherwise(0.0) + F.when(in_year & F.lower("column_header").contains("năm nay"), 10.0).otherwise(0.0)
        - F.when(F.greatest(*[identity.contains(w) for w in P.NARRATIVE]), 25.0).otherwise(0.0)
    ) if not ignore_unit else F.col("score") * 100 + F.when(in_year, 1e-4).otherwise(0.0)
    place = F.row_number().over(by.orderBy(F.desc("ok"), F.desc(F.round(weight, 6)), F.desc("table_key"), "row_index", "column_index"))
    count = lambda c: F.count_if(F.col(c)).over(by)
    o = o.withColumn("n1", count("ok_company")).withColumn("n2", count("ok_shape")).withColumn("n3", count("ok_year")).withColumn("n4", count("ok")).withColumn("_r", place).filter("_r = 1")
    unit = L.requested_unit(F.col("question"))
    j = asked.select("id", "question").join(o.drop("question"), "id", "left").withColumn("unit", unit)
    factor, answer, unknown = _unit_answer(F.col("numeric_value"), F.col("source_scale"), F.col("unit"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    tests = [zero("n1"), zero("n2"), zero("n3"), zero("n4"), F.lit(False) if ignore_unit else unknown]
    reason = F.lit(None).cast("string")
    for test, text in reversed(list(zip(tests, REASONS))):
        reason = F.when(test, text).otherwise(reason)
    j = j.withColumn("factor", factor).withColumn("answer", answer).withColumn("reason", reason)
    good = lambda c: F.when(F.col("reason").isNull(), F.col(c)).alias(c)
    return j.select("id", *[good(c) for c in ("table_key", "row_index", "column_index", "numeric_value", "factor", "answer")], "unit", "reason")


def extrema(ops: DataFrame, asked: DataFrame, ignore_unit: bool = False) -> DataFrame:
    """Questions for the largest or smallest over several named years, as `lookups` has rows; also mode (year or value).

    Per year the best operand is taken; a year without one is the reason for no answer. The earlier year wins ties. In mode
    year the answer is the year, its cell the evidence.
    """
    e = asked.withColumn("e", P.extremum(F.col("question"), years(F.col("question")))).filter("e is not null").withColumn("named", years(F.col("question")))
    o = candidates(ops, e)
    flags = o.groupBy("id").agg(F.count_if("ok_company").alias("n1"), F.count_if("ok_shape").alias("n2"))
    o = o.filter("ok_shape").join(e.select("id", F.explode("named").alias("asked")), "id")
    o = o.filter((F.col("year") == F.col("asked")) | F.col("column_header").contains(F.col("asked").cast("string")))
    w = Window.partitionBy("id", "asked").orderBy(F.desc("score"), F.desc("table_key"), "row_index", "column_index")
    best = o.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    cell = F.struct("asked", "table_key", "row_index", "column_index", "numeric_value", "source_scale")
    best = best.groupBy("id").agg(F.max_by(cell, F.struct("numeric_value", -F.col("asked"))).alias("most"), F.min_by(cell, F.struct("numeric_value", "asked")).alias("least"), F.count("*").alias("n_years"))
    j = e.select("id", "question", "e", F.size("named").alias("n_asked")).join(flags, "id", "left").join(best, "id", "left")
    c = F.when(F.col("e.direction") == "max", F.col("most")).otherwise(F.col("least"))
    j = j.withColumn("c", c).withColumn("unit", F.when(F.col("e.mode") == "value", L.requested_unit(F.col("question"))))
    factor, value, unknown = _unit_answer(F.col("c.numeric_value"), F.col("c.source_scale"), F.col("unit"))
    zero = lambda n: F.coalesce(F.col(n), F.lit(0)) == 0
    reason = F.when(zero("n1"), REASONS[0]).when(zero("n2"), REASONS[1]).when(F.coalesce("n_years", F.lit(0)) < F.col("n_asked"), REASONS[2])
    if not ignore_unit:
        reason = F.coalesce(reason, F.when(unknown, REASONS[4]))
    j = j.withColumn("reason", reason).withColumn("factor", factor).withColumn("answer", F.when(F.col("e.mode") == "year", F.col("c.asked").cast("double")).otherwise(value))
    good = lambda x, name: F.when(F.col("reason").isNull(), x).alias(name)
    return j.select("id", *[good(F.col(f"c.{n}"), n) for n in ("table_key", "row_index", "column_index", "numeric_value")], good(F.col("factor"), "factor"), good(F.col("answer"), "answer"), "unit", "reason", F.col("e.mode").alias("mode"))


def rendered(mode: Column, answer: Column, factor: Column) -> Column:
    """The expression over the cell x that gives the answer; a year is a number by itself."""
    return F.when(mode == "year", answer.cast("string")).when(factor == 1, F.lit("x")).otherwise(F.concat(F.lit("x * "), factor.cast("string")))


def routes(questions: DataFrame, pairs: DataFrame, tables: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, question, family, tickers, route) of every question: extremum, lookup, or model for questions of several cells."""
    q = questions.select("id", "question").dropDuplicates(["id"])
    av = available_tickers(pairs, tables)
    none = F.array().cast("array<string>")
    q = q.join(av, "id", "left").withColumn("available", F.coalesce("available", none)).join(precise_tickers(q, av, companies), "id")
    q = q.withColumn("family", L.family(F.col("question"), F.col("available")))
    extreme = P.extremum(F.col("question"), years(F.col("question"))).isNotNull()
    route = F.when(F.col("family") != "direct_lookup", "model").when(extreme, "extremum").otherwise("lookup")
    return q.select("id", "question", "family", "tickers", route.alias("route"))


def routed(questions: DataFrame, pairs: DataFrame, tables: DataFrame, companies: DataFrame, ops: DataFrame, ignore_unit: bool = False) -> DataFrame:
    """Every question with the way it is answered: id, question, family, tickers, route, table_key, row_index, column_index, answer, expression, unit, reason.

    Routes are those of `routes`; questions for a model have no answer here. ops: ordered operands with source_scale of the
    tables in pairs (id, table_key).
    """
    q = settle(routes(questions, pairs, tables, companies))
    asked = lambda r: q.filter(F.col("route") == r).select("id", "question", "tickers")
    one = lookups(ops, asked("lookup"), ignore_unit).withColumn("mode", F.lit("value"))
    got = one.unionByName(extrema(ops, asked("extremum"), ignore_unit)).withColumn("expression", F.when(F.col("reason").isNull(), rendered(F.col("mode"), F.col("answer"), F.col("factor"))))
    j = q.select("id", "question", "family", "tickers", "route").join(got.drop("mode", "factor", "numeric_value"), "id", "left")
    return j.withColumn("reason", F.when(F.col("route") == "model", F.lit("needs a model")).otherwise(F.col("reason")))


def modelled(questions: DataFrame, ops: DataFrame, complete: Callable[[str], str], retries: int = 2, most: int = MODEL_OPERANDS) -> DataFrame:
    """Questions answered by plans of a text model: id, answer, expression, cells, attempts, reason; one row per question.

    questions: id, question, family, tickers. ops: ordered operands (pos). complete goes to the workers and is called with a
    prompt of the first `most` operands of one question; a plan is validated against exactly those. A question without
    operands is not sent. At most `most` rows of a question come together.
    """
    from .complete import Asked, Fact, answer
    from .diagnose import SEVERAL

    import pandas as pd

    fields = ["pos", "table_key", "row_index", "column_index", "row_label", "column_header", "numeric_value", "ticker", "year", "variant"]
    shown = ops.filter(F.col("pos") <= most).groupBy("id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("cells"))
    q = questions.select("id", "question", "family", "tickers", years(F.col("question")).alias("years"), variant(F.col("question")).alias("variant"))
    j = q.join(shown, "id", "left").withColumn("cells", F.coalesce("cells", F.array().cast(shown.schema["cells"].dataType)))

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                facts = {(c["table_key"], int(c["row_index"]), int(c["column_index"])): Fact(c["row_label"] or "", c["column_header"] or "", float(c["numeric_value"]), c["ticker"], c["year"], c["variant"]) for c in r.cells}
                if not facts:
                    rows.append((r.id, None, None, [], 0, "no operand fits"))
                    continue
                have = {f.ticker for f in facts.values()}
                asked = Asked(frozenset(int(y) for y in r.years), r.variant, frozenset(t for t in r.tickers if t in have), r.family in SEVERAL)
                a = answer(r.question or "", facts, complete, retries, asked=asked)
                rows.append((r.id, a.value, a.expression, [{"table_key": k[0], "row_index": k[1], "column_index": k[2]} for k in a.cells], len(a.errors) + (a.value is not None), None if a.value is not None else a.errors[-1]))
            yield pd.DataFrame(rows, columns=["id", "answer", "expression", "cells", "attempts", "reason"])

    kind = questions.schema["id"].dataType.simpleString()
    return j.mapInPandas(run, f"id {kind}, answer double, expression string, cells array<struct<table_key:string,row_index:int,column_index:int>>, attempts int, reason string")
