"""Comma-separated lines that may fail to parse: typed rows on one side, reasons on the other.

Lines are split on the double quote, which puts text outside quotes at even and quoted text at odd
places; no backtracking regex runs over a whole line, so very long lines are safe. Parsed cells are
exploded to (line, column, value), joined with a table of rules, and the failures are aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let

# Layouts of the feeds.
LAYOUTS = {
    "candidates": ("report_id", "line_position", "page", "section_header", "status", "n_rows", "n_cols", "preceding_unit_declaration", "warnings", "source_path"),
    "anomalies": ("table_key", "report_id", "line_position", "source_path", "anomaly"),
}
STATUSES = ("success", "parsed_with_warnings", "failed")
RULES = (
    ("candidates", 0, "filled"),
    ("candidates", 1, "count_from_1"),
    ("candidates", 2, "empty_or_count_from_1"),
    ("candidates", 4, "status"),
    ("candidates", 5, "count_from_0"),
    ("candidates", 6, "count_from_0"),
    ("candidates", 8, "json_strings"),
    ("anomalies", 0, "table_key"),
    ("anomalies", 1, "filled"),
    ("anomalies", 2, "count_from_1"),
    ("anomalies", 4, "anomaly"),
)

_MARK, _SEP, _ESC = "\u0001", "\u0001s", "\u0001e"


def well_quoted(raw: Column) -> Column:
    """Whether each double quote encloses a whole field or is doubled inside one."""

    def check(seg):
        n = F.size(seg)
        inner = F.forall(
            F.transform(seg, lambda s, i: (i % 2 == 1) | (i == 0) | (i == n - 1) | (s == "") | (s.startswith(",") & s.endswith(","))),
            lambda ok: ok,
        )
        first, last = F.element_at(seg, 1), F.element_at(seg, -1)
        edges = ((first == "") | first.endswith(",")) & ((last == "") | last.startswith(","))
        return (n == 1) | ((n % 2 == 1) & inner & edges)

    return let(F.split(F.coalesce(raw, F.lit("")), '"', -1), check)


def record_fields(raw: Column) -> Column:
    """Fields of a well-quoted line, quotes taken off; null counts as the empty line, which has one empty field."""

    def parts(seg):
        n = F.size(seg)
        return F.transform(
            seg,
            lambda s, i: F.when(i % 2 == 1, s).when((s == "") & (i > 0) & (i < n - 1), F.lit('"')).otherwise(F.replace(s, F.lit(","), F.lit(_SEP))),
        )

    escaped = F.replace(F.coalesce(raw, F.lit("")), F.lit(_MARK), F.lit(_ESC))
    joined = F.array_join(let(F.split(escaped, '"', -1), parts), "")
    return F.transform(F.split(joined, _SEP, -1), lambda f: F.replace(f, F.lit(_ESC), F.lit(_MARK)))


def strict_json_strings(c: Column) -> Column:
    """Whether c is a strict JSON array of strings: escapes, then strings, then blanks are reduced in turn."""
    plain = F.regexp_replace(c, r'\\(["\\/bfnrt]|u[0-9a-fA-F]{4})', "x")
    marked = F.regexp_replace(plain, r'"[^"\\\x00-\x1f]*+"', _MARK)
    tight = F.regexp_replace(marked, r"[ \t\n\r]+", "")
    listed = (F.replace(tight, F.lit("," + _MARK), F.lit("")) == f"[{_MARK}]") & tight.startswith("[" + _MARK)
    return ~plain.contains(_MARK) & ((tight == "[]") | listed)


def _above(digits: Column, limit: int) -> Column:
    d = F.ltrim(digits, F.lit("0"))
    width = len(str(limit))
    return digits.rlike("^[0-9]+$") & ((F.length(d) > width) | ((F.length(d) == width) & (d > str(limit))))


def _holds(rule: Column, v: Column, expected_key: Column) -> Column:
    count_from_1 = v.rlike(r"^[0-9]*[1-9][0-9]*\z")
    shape = F.when(v.startswith("n_rows>200:"), _above(F.substr(v, F.lit(12)), 200)).when(v.startswith("n_cols>50:"), _above(F.substr(v, F.lit(11)), 50)).otherwise(False)
    return (
        F.when(rule == "filled", v != "")
        .when(rule == "count_from_1", count_from_1)
        .when(rule == "empty_or_count_from_1", (v == "") | count_from_1)
        .when(rule == "count_from_0", v.rlike(r"^[0-9]+\z"))
        .when(rule == "status", v.isin(*STATUSES))
        .when(rule == "json_strings", strict_json_strings(v))
        .when(rule == "table_key", v == expected_key)
        .when(rule == "anomaly", shape)
    )


def parsed_lines(feed: DataFrame) -> DataFrame:
    """feed with columns `cells` (fields) and `early` (quoting, column_count or null).

    A null or empty line has one field, so it fails by column_count; so does every line of an unknown or null feed.
    """
    width = F.lit(None).cast("int")
    for name, cols in LAYOUTS.items():
        width = F.when(F.col("feed") == name, len(cols)).otherwise(width)
    cells = record_fields(F.col("raw_line"))
    return feed.withColumn("quoted_well", well_quoted(F.col("raw_line"))).withColumn("cells", F.when(F.col("quoted_well"), cells)).withColumn(
        "early", F.when(~F.col("quoted_well"), "quoting").when(width.isNull() | (F.size("cells") != width), "column_count")
    )


def cell_failures(parsed: DataFrame) -> DataFrame:
    """(line_id, position, rule, value) of each cell that breaks its rule, for lines that are well formed."""
    spark = parsed.sparkSession
    rules = F.broadcast(spark.createDataFrame(list(RULES), "feed string, position int, rule string"))  # a fixed table of a few rows
    cells = parsed.filter(F.col("early").isNull()).select("line_id", "feed", F.concat_ws("|", F.col("cells")[1], F.col("cells")[2]).alias("expected_key"), F.posexplode("cells").alias("position", "value"))
    return cells.join(rules, ["feed", "position"]).filter(~_holds(F.col("rule"), F.col("value"), F.col("expected_key"))).select("line_id", "position", "rule", "value")


def rejected(feed: DataFrame) -> DataFrame:
    """line_id and the first reason that holds (quoting, column_count, invalid_value), and the broken rules in column order.

    feed needs line_id (unique), feed and raw_line. Repeated lines fail or load each for itself.
    """
    parsed = parsed_lines(feed)
    early = parsed.filter(F.col("early").isNotNull()).select("line_id", F.col("early").alias("reason"), F.array().cast("array<string>").alias("broken"))
    late = (
        cell_failures(parsed)
        .groupBy("line_id")
        .agg(F.sort_array(F.collect_list(F.struct("position", "rule"))).alias("b"))  # at most one entry per column
        .select("line_id", F.lit("invalid_value").alias("reason"), F.transform("b", lambda x: x["rule"]).alias("broken"))
    )
    return early.unionByName(late)


def loaded(feed: DataFrame, name: str) -> DataFrame:
    """Typed rows of one feed; warnings become an array, an empty page null, counts beyond BIGINT null."""
    parsed = parsed_lines(feed).filter((F.col("feed") == name) & F.col("early").isNull())
    clean = parsed.join(cell_failures(parsed).select("line_id").distinct(), "line_id", "left_anti")
    cols = []
    for i, c in enumerate(LAYOUTS[name]):
        v = F.col("cells")[i]
        if c in ("line_position", "page", "n_rows", "n_cols"):
            v = v.try_cast("bigint")
        elif c == "warnings":
            v = F.from_json(v, "array<string>")
        cols.append(v.alias(c))
    return clean.select("line_id", *cols)
