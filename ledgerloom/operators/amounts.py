"""Quantities in different units brought to VND, and unit changes inside a source's history.

Stated units are read from text: column header, else caption, else declaration, else the detected units
and the currency hint. Where nothing states them, `unit_shifts` segments each history of yearly log values
by an exact penalised changepoint search; level shifts that match a known factor mark a change of unit, and
`inferred_units` reverses them for the cells without a unit, which are marked as inferred.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold, let
from ..functions.units import amount, currency_of, declared_phrase, is_amount, scale_of, unit_phrase
from ..session import join_checked, settle
from .link import is_value_column

HEADER_ROWS = 6
#: A cell that is a period, a year or a day of one, though it reads as an amount.
PERIOD_CELL = r"^(?:[0-9]{1,2}[./-][0-9]{1,2}[./-])?(?:19|20)[0-9]{2}$"
#: Headers of balances and flows of the year before, folded.
OPENING_DAY = r"(?<![0-9])0?1[./-]0?1[./-]((?:19|20)[0-9]{2})(?![0-9])"
YEAR_BEFORE = r"(?<![a-z])(?:(?:nam|ky) truoc|dau (?:nam|ky)|(?:prior|previous|last) (?:year|period)|opening|beginning)(?![a-z])"
#: Powers of ten between known units of money.
FACTORS = (3, 6, 9, 12)


def header_phrase(grid: Column, row: Column, col: Column) -> Column:
    """The unit in the header cells above (row, col): the first of at most HEADER_ROWS rows that has one."""
    above = F.slice(grid, F.lit(1), F.least(F.greatest(row, F.lit(0)), F.lit(HEADER_ROWS)))
    # A cell of digits and marks alone has no unit; most cells are left out by this cheap test.
    worded = F.filter(F.transform(above, lambda r: F.get(r, col)), lambda t: F.length(F.translate(t, "0123456789.,()-/% ", "")) > 0)
    found = F.filter(F.transform(worded, unit_phrase), lambda p: p.isNotNull())
    return F.get(found, F.lit(0))


def stated_phrase(header: Column, captions: Column, declaration: Column) -> Column:
    """Unit phrase by precedence: header, else the last caption that declares one, else the declaration."""
    said = F.filter(F.transform(captions, declared_phrase), lambda p: p.isNotNull())
    return F.coalesce(header, F.try_element_at(said, F.lit(-1)), unit_phrase(declaration))


def table_year(year: Column, report_id: Column) -> Column:
    return F.coalesce(year, F.regexp_extract(report_id, r"_(20[0-9]{2})(?:_|$)", 1).try_cast("int"))


def with_vnd(df: DataFrame, rates: DataFrame, value: str, phrase: str, year: str, out: str) -> DataFrame:
    """df plus column out: value in VND; null where unit, number or rate is missing. rates is a fixed, small table."""
    r = rates.select(F.col("currency").alias("_cur"), F.col("fx_year").alias("_fy"), F.col("vnd_per_unit").alias("_rate"))
    df = df.withColumn("_c", currency_of(F.col(phrase)))
    df = df.join(r, (F.col("_c") == F.col("_cur")) & (F.col(year) == F.col("_fy")), "left")
    rate = F.when(F.col("_c") == "VND", F.lit(1.0)).otherwise(F.col("_rate"))
    return df.withColumn(out, F.col(value) * scale_of(F.col(phrase)) * rate).drop("_c", "_cur", "_fy", "_rate")


def off_answers(answers: DataFrame, tables: DataFrame, rates: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Answers with the cited cell in VND and whether they are off by more than tolerance of the cell.

    One row per distinct answer. The cell's unit is the one stated; where nothing states it, the one that the changepoint
    search over the history of the cell's series gives (`inferred_units`; unit_source tells which). Answers citing no
    cell, a cell that isn't there or isn't a number, or units that can't be brought to VND have off = null. Of tables delivered twice the smallest record_id
    counts. A table key that is cited very often is split by AQE's skew join; only needed columns move.
    """
    a = answers.filter(F.col("table_key").isNotNull() & F.col("row_index").isNotNull() & F.col("column_index").isNotNull())
    a = a.select("id", "expected_answer", "expected_unit", "table_key", "row_index", "column_index").distinct()
    t = tables.filter(F.size("grid") > 0).select("table_key", "record_id", "report_id", "year", "unit_declaration", "caption_context", "grid")
    j = a.join(t, "table_key").select(
        "id", "expected_answer", "expected_unit", "table_key", "row_index", "column_index", "record_id",
        F.get(F.get("grid", F.col("row_index")), F.col("column_index")).alias("cell"),
        header_phrase(F.col("grid"), F.col("row_index"), F.col("column_index")).alias("header_unit"),
        "caption_context", "unit_declaration", table_year(F.col("year"), F.col("report_id")).alias("fx_of"),
    )
    j = j.withColumn("cell_unit", stated_phrase(F.col("header_unit"), F.col("caption_context"), F.col("unit_declaration")))
    j = settle(j.withColumn("cell_value", amount(F.col("cell"))).withColumn("answer_unit", unit_phrase(F.col("expected_unit"))).drop("header_unit", "caption_context", "unit_declaration"))
    j = j.withColumn("unit_source", F.when(F.col("cell_unit").isNotNull(), "stated"))
    lost = j.filter("cell_unit is null and cell_value is not null")
    if _HISTORY <= set(tables.columns) and not lost.isEmpty():  # only histories of cells without a stated unit are searched
        who = settle(tables.join(lost.select("record_id").distinct(), "record_id", "left_semi").select("ticker", "variant").distinct())
        guess = inferred_units(with_units(join_checked(tables, who, ["ticker", "variant"], "left_semi", 64))).select("record_id", "row_index", "column_index", F.col("unit").alias("_unit"), "power")
        j = j.join(guess, ["record_id", "row_index", "column_index"], "left")
        j = j.withColumn("unit_source", F.coalesce("unit_source", F.when(F.col("_unit").isNotNull(), "inferred"))).withColumn("cell_unit", F.coalesce("cell_unit", "_unit"))
        # Reversed to the unit of the segment that states it.
        j = j.withColumn("cell_value", F.when(F.col("unit_source") == "inferred", F.col("cell_value") / F.pow(F.lit(10.0), F.col("power").cast("double"))).otherwise(F.col("cell_value"))).drop("_unit", "power")
    j = with_vnd(j, rates, "cell_value", "cell_unit", "fx_of", "cell_vnd")
    j = with_vnd(j, rates, "expected_answer", "answer_unit", "fx_of", "answer_vnd")
    j = j.withColumn("off", F.abs(F.col("answer_vnd") - F.col("cell_vnd")) > tolerance * F.abs(F.col("cell_vnd")))
    keys = ["id", "expected_answer", "expected_unit", "table_key", "row_index", "column_index"]
    kept = ["cell", "cell_unit", "unit_source", "cell_value", "cell_vnd", "answer_vnd", "off"]
    return j.groupBy(*keys).agg(F.min_by(F.struct(*kept), "record_id").alias("r")).select(*keys, "r.*")


#: Columns that a table's place in a history needs.
_HISTORY = {"ticker", "variant", "header_depth", "column_metadata"}


def agreed_unit(detected: Column, hint: Column) -> Column:
    """The unit phrase on which all detected units agree, else that of the currency hint."""
    said = F.array_distinct(F.filter(F.transform(detected, unit_phrase), lambda p: p.isNotNull()))
    return F.coalesce(F.when(F.size(said) == 1, F.get(said, F.lit(0))), unit_phrase(hint))


def with_units(tables: DataFrame) -> DataFrame:
    """Tables with a grid plus fx_of (year), heads (unit by column header), other (by caption or declaration), hint (detected)."""
    col = lambda c, kind: F.col(c) if c in tables.columns else F.lit(None).cast(kind)
    t = tables.filter(F.size("grid") > 0)
    width = F.aggregate("grid", F.lit(0), lambda m, r: F.greatest(m, F.size(r)))
    heads = F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda c: header_phrase(F.col("grid"), F.size("grid"), c))
    t = t.withColumn("fx_of", table_year(F.col("year"), F.col("report_id"))).withColumn("heads", heads)
    t = t.withColumn("other", stated_phrase(F.lit(None).cast("string"), F.col("caption_context"), F.col("unit_declaration")))
    return t.withColumn("hint", agreed_unit(col("detected_units", "array<string>"), col("currency_hint", "string")))


def table_amounts(tables: DataFrame, rates: DataFrame) -> DataFrame:
    """Every numeric cell below the header of every table, as recorded and in VND.

    Columns record_id, table_key, row_index, column_index, value, unit (folded phrase or null), value_vnd
    (null where no unit is known or no rate), unit_source: stated (header, caption, declaration), detected
    (detected units that agree, else the currency hint), inferred (from the history of the cell's series, see
    `inferred_units`) or null. Null or empty grids give no row. Tables without the columns that an inference
    or detection needs go without it.
    """
    t = with_units(tables)
    known = ["record_id", "table_key", "fx_of", "heads", "other", "hint"]
    cells = t.select(*known, F.posexplode("grid").alias("row_index", "row")).filter(F.col("row_index") > 0)
    cells = cells.select(*known, "row_index", F.posexplode("row").alias("column_index", "cell")).filter(F.col("column_index") > 0)
    cells = cells.filter(is_amount(F.col("cell"))).withColumn("value", amount(F.col("cell")))
    stated = F.coalesce(F.get("heads", F.col("column_index")), F.col("other"))
    cells = cells.withColumn("unit", F.coalesce(stated, F.col("hint"))).withColumn("unit_source", F.when(stated.isNotNull(), "stated").when(F.col("hint").isNotNull(), "detected"))
    cells = cells.drop("heads", "other", "hint", "cell")
    if _HISTORY <= set(tables.columns):
        guess = inferred_units(t)
        cells = cells.filter("unit is not null").withColumn("power", F.lit(0)).unionByName(
            cells.filter("unit is null").drop("unit", "unit_source").join(guess, ["record_id", "row_index", "column_index"], "left").withColumn("unit_source", F.when(F.col("unit").isNotNull(), "inferred")).withColumn("power", F.coalesce("power", F.lit(0)))
        )
    else:
        cells = cells.withColumn("power", F.lit(0))
    out = with_vnd(cells, rates, "value", "unit", "fx_of", "value_vnd").withColumn("value_vnd", F.col("value_vnd") / F.pow(F.lit(10.0), F.col("power").cast("double")))
    return out.select("record_id", "table_key", "row_index", "column_index", "value", "unit", "value_vnd", "unit_source")


def inferred_units(t: DataFrame) -> DataFrame:
    """record_id, row_index, column_index, unit, power of amount cells without a known unit: the unit stated most often in the latest
    segment of the cell's series that states one, and the power of ten to divide by to reach that segment's unit.

    t: tables with heads, other and hint. Only series that hold such a cell are segmented; cells of series
    that never state a unit give no row.
    """
    points = settle(amount_points(t))
    lost = points.filter("unit is null and year is not null")
    mine = settle(points.join(lost.select("series").distinct(), "series", "left_semi"))
    segments = settle(unit_shifts(mine.select("series", "year", "value", "unit")).select("series", "segment", "first_year", "last_year", "unit_power"))
    inside = (F.col("p.series") == F.col("s.series")) & F.col("p.year").between(F.col("s.first_year"), F.col("s.last_year"))
    said = mine.filter("unit is not null").groupBy("series", "year", "unit").count()
    told = said.alias("p").join(segments.alias("s"), inside).groupBy("p.series", "segment", "unit_power", "unit").agg(F.sum("count").alias("n"))
    best = told.groupBy("series").agg(F.max_by(F.struct("unit", F.col("unit_power").alias("base")), F.struct("segment", "n", "unit")).alias("b")).select("series", "b.*")
    placed = lost.alias("p").join(segments.alias("s"), inside).select("record_id", "row_index", "column_index", "p.series", "unit_power")
    return placed.join(best, "series").select("record_id", "row_index", "column_index", "unit", (F.col("unit_power") - F.col("base")).alias("power"))


def pelt(y: np.ndarray, penalty: float) -> list[int]:
    """Starts of the segments that minimise squared error plus penalty per change, exactly, with pruning."""
    n = len(y)
    s1, s2 = np.concatenate([[0], np.cumsum(y)]), np.concatenate([[0], np.cumsum(y * y)])
    best, prev, live = np.zeros(n + 1), np.zeros(n + 1, dtype=np.int64), np.array([0])
    best[0] = -penalty
    for e in range(1, n + 1):
        m = s1[e] - s1[live]
        cost = best[live] + (s2[e] - s2[live]) - m * m / (e - live)
        i = int(np.argmin(cost))
        best[e], prev[e] = cost[i] + penalty, live[i]
        live = np.append(live[cost <= best[e]], e)
    starts, e = [], n
    while e > 0:
        e = int(prev[e])
        starts.append(e)
    return starts[::-1]


def _segment(batches, penalty: float, slack: float):
    for pdf in batches:
        out = []
        for key, points in zip(pdf["series"], pdf["points"]):
            years = [p["year"] for p in points]
            y = np.array([p["level"] for p in points], dtype=float)
            starts = pelt(y, penalty)
            ends = [*starts[1:], len(y)]
            means = [float(y[a:b].mean()) for a, b in zip(starts, ends)]
            said = [sorted(p["scale"] for p in points[a:b] if p["scale"] is not None) for a, b in zip(starts, ends)]
            said = [v[len(v) // 2] if v else None for v in said]
            shift, power, why = [0.0] * len(means), [0] * len(means), ["latest"] * len(means)
            for k in range(len(means) - 2, -1, -1):  # against the latest segment, whose unit stands
                step = means[k] - means[k + 1]
                near = min((s * f for f in FACTORS for s in (1, -1)), key=lambda f: abs(step - f))
                found = near if abs(step - near) <= slack else 0
                if said[k] is not None and said[k + 1] is not None:  # stated units win over the search
                    stated = said[k + 1] - said[k]
                    why[k] = "none" if found == stated == 0 else "confirmed" if found == stated else "refuted"
                    found = stated
                else:
                    why[k] = "inferred" if found else "none"
                power[k] = power[k + 1] + found
                shift[k] = step
            out += [(key, k, int(years[a]), int(years[b - 1]), b - a, round(means[k], 6), round(shift[k], 6), power[k], why[k]) for k, (a, b) in enumerate(zip(starts, ends))]
        yield pd.DataFrame(out, columns=["series", "segment", "first_year", "last_year", "n_years", "mean_log10", "step_log10", "unit_power", "evidence"])


def unit_shifts(history: DataFrame, penalty: float = 2.0, slack: float = 0.35) -> DataFrame:
    """Segments of each series' yearly levels; unit_power is the power of ten to divide by to reach the latest unit.

    history: series STRING, year INT, value DOUBLE, optionally unit STRING (the phrase stated for the value). Nulls and
    zeros are left out. The points of a series are first reduced to one median per year, so an array never holds more
    points than there are years, however many rows a series has. A level shift within slack of a known factor counts as a
    unit change. Where both sides state units, these decide: evidence is confirmed or refuted then, else inferred, none
    without a change, latest for the last segment.
    """
    scale = F.round(F.log10(scale_of(F.col("unit")))).cast("int") if "unit" in history.columns else F.lit(None).cast("int")
    kept = history.filter(F.col("series").isNotNull() & F.col("year").isNotNull() & (F.abs("value") > 0)).withColumn("_scale", scale)
    yearly = kept.groupBy("series", "year").agg(F.percentile_approx(F.log10(F.abs("value")), 0.5, 1000).alias("level"), F.percentile_approx("_scale", 0.5, 100).alias("scale"))
    points = yearly.groupBy("series").agg(F.sort_array(F.collect_list(F.struct("year", "level", "scale"))).alias("points"))
    schema = "series string, segment int, first_year int, last_year int, n_years int, mean_log10 double, step_log10 double, unit_power int, evidence string"
    return points.mapInPandas(lambda it: _segment(it, penalty, slack), schema)


def reversed_history(history: DataFrame, segments: DataFrame) -> DataFrame:
    """history plus value_latest: the value in the unit of its series' latest segment, the changes of unit reversed.

    Segments are fewer than the years of a series; a series of very many rows is split by AQE's skew join. Rows without
    a series, a year or a value in no segment (zeros, nulls) keep null.
    """
    s = segments.select("series", "first_year", "last_year", "unit_power")
    by = s.groupBy("series").agg(F.collect_list(F.struct("first_year", "last_year", "unit_power")).alias("_s"))
    at = F.get(F.filter("_s", lambda x: F.col("year").between(x["first_year"], x["last_year"])), F.lit(0))
    return history.join(by, "series", "left").withColumn("value_latest", F.when(F.col("value") != 0, F.col("value") / F.pow(F.lit(10.0), at["unit_power"].cast("double")))).drop("_s")


def head_rows(grid: Column, depth: Column) -> Column:
    """How many rows at the top are header: the first, the declared depth and those repeating the first row's
    first cell, as spans leave them; none from the first row on that holds an amount other than a period."""
    first = F.get(F.get(grid, F.lit(0)), F.lit(0))
    period = lambda c: F.trim(c).rlike(PERIOD_CELL)
    counted = lambda r: F.exists(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), lambda c: is_amount(c) & ~period(c))
    head = lambda r, i: ((i == 0) | (i < F.coalesce(depth, F.lit(0))) | F.get(r, F.lit(0)).eqNullSafe(first)) & ~F.coalesce(counted(r), F.lit(False))
    top = F.slice(grid, 1, HEADER_ROWS)
    end = F.array_position(F.transform(top, head), F.lit(False))
    return F.when(end > 0, (end - 1).cast("int")).otherwise(F.size(top))


def period_year(header: Column, year: Column) -> Column:
    """The year a column's amounts are of: the one in its header (an opening balance of 1 January is of the
    year before), else the year before for a header that says so, else the table's."""
    h = fold(header)
    opening, named = F.regexp_extract(h, OPENING_DAY, 1).try_cast("int"), F.regexp_extract(h, r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])", 1).try_cast("int")
    return F.coalesce(opening - 1, named, F.when(h.rlike(YEAR_BEFORE), year - 1).otherwise(year))


def amount_rows(tables: DataFrame, *keep: Column) -> DataFrame:
    """keep, row_index, row, series and cols of every row below the header; cols has the year and whether it can hold amounts (ok) by column."""
    t = tables.filter(F.size("grid") > 0).withColumn("_year", table_year(F.col("year"), F.col("report_id"))).withColumn("_head", head_rows(F.col("grid"), F.col("header_depth")))
    width = F.aggregate("grid", F.lit(0), lambda m, r: F.greatest(m, F.size(r)))
    paths = F.map_from_entries(F.array_distinct(F.transform(F.coalesce("column_metadata", F.array().cast(tables.schema["column_metadata"].dataType)), lambda m: F.struct(m["column_index"], m["header_path"]))))

    def columns(by_column):
        def column(i):
            said = F.array_compact(F.concat(F.transform(F.slice("grid", F.lit(1), F.col("_head")), lambda r: F.get(r, i)), F.array(F.try_element_at(by_column, i))))
            return let(said, lambda h: F.named_struct(F.lit("year"), period_year(F.array_join(h, " "), F.col("_year")), F.lit("ok"), F.forall(h, lambda x: is_value_column(i, x))))

        return F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), column)

    who = F.concat_ws("|", "ticker", "variant")
    # Columns are worked out once a table, before its rows are exploded.
    t = t.select(*keep, who.alias("_who"), "_head", "grid", let(paths, columns).alias("cols"))
    rows = t.select(*t.columns, F.posexplode("grid").alias("row_index", "row")).drop("grid").filter("row_index >= _head")
    return rows.withColumn("series", F.concat_ws("|", "_who", F.trim(F.regexp_replace(fold(F.get("row", F.lit(0))), r"\s+", " ")))).drop("_who", "_head")


def label_history(tables: DataFrame) -> DataFrame:
    """series (ticker, variant, folded row label), year, value as recorded: every numeric cell of the columns
    that can hold amounts, whatever its size, with the year of its own column. Codes and notes are left out by header."""
    return amount_points(tables, False).select("series", "year", "value")


def amount_points(tables: DataFrame, units: bool = True) -> DataFrame:
    """label_history with record_id, row_index and column_index, and with units the unit stated or detected for each value."""
    t = (tables if "heads" in tables.columns else with_units(tables)) if units else tables
    keep = [F.col("record_id"), F.col("heads"), F.coalesce("other", "hint").alias("known")] if units else []
    cells = F.filter(F.transform("row", lambda c, i: F.struct(i.alias("i"), F.get("cols", i).alias("c"), c.alias("cell"))), lambda x: x["c"]["ok"] & is_amount(x["cell"]))
    rows = amount_rows(t, *keep).select(*(["record_id", "row_index", "heads", "known"] if units else []), "series", F.explode(cells).alias("x"))
    own = ["record_id", "row_index", F.col("x.i").alias("column_index"), F.coalesce(F.get("heads", F.col("x.i")), F.col("known")).alias("unit")] if units else []
    return rows.select(*own, "series", F.col("x.c.year").alias("year"), amount(F.col("x.cell")).alias("value"))
