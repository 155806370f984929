"""Table metadata inferred from grids, all as JVM expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold, truncated
from .extract import UNIT_WORDS, strip

# Patterns and bounds of the catalog.
PERIOD = r"(?iu)20[0-9]{2}|31\s*[./-]\s*12|01\s*[./-]\s*01|số\s+(?:cuối|đầu)\s+(?:năm|kỳ)|năm\s+(?:nay|trước)"
NUMERIC = r"^[\s\p{Z}()\-+.,%\p{Nd}]+$"
FOREIGN = r"(?iu)\busd\b|us\$|\beur\b|\bjpy\b|\bcny\b|\bsgd\b"
VARIANTS = (("consolidated", "consolidated"), ("separate", "separate"), ("aggregated", "aggregated"), ("explanation", "explanatory"), ("explanatory", "explanatory"))
HEADER_ROWS, MAX_LABELS, MAX_HEADERS, MAX_PERIODS = 6, 200, 60, 40


def report_parts(rid: Column) -> dict[str, Column]:
    """ticker, year, variant and part of a report id; absent parts are null, an unnamed variant is unspecified."""
    variant = F.lit("unspecified")
    for word, name in reversed(VARIANTS):
        variant = F.when(F.lower(rid).contains(word), F.lit(name)).otherwise(variant)
    return {
        "ticker": F.substring_index(rid, "_", 1),
        "year": F.regexp_extract(rid, r"(20[0-9]{2})", 1).try_cast("int"),
        "variant": variant,
        "part": F.regexp_extract(rid, r"_([0-9]{1,2})$", 1).try_cast("int"),
    }


def units_in(c: Column) -> Column:
    """Unit phrases in order of appearance, as written, each spelling once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?iu)({UNIT_WORDS})"), 1))


def unit_scale(c: Column, word_anchored: bool = False) -> Column:
    """VND per unit as BIGINT, null for none. By default any occurrence counts, also inside a word."""
    t = F.regexp_replace(fold(c), r"\s+", " ")
    has = (lambda w: t.rlike(rf"(?<![a-z0-9])(?:{w})(?![a-z0-9])")) if word_anchored else (lambda w: t.rlike(w))
    return F.when(has("nghin ty"), 10**12).when(has("ty"), 10**9).when(has("trieu"), 10**6).when(has("nghin"), 1000).when(has("vnd|dong"), 1).cast("bigint")


def is_numeric(c: Column) -> Column:
    """Whether a stripped cell holds nothing but digits, signs, marks and blanks."""
    return c.rlike(NUMERIC)


def _labels(grid: Column, rows: Column, keep) -> Column:
    """Structs (row_index, column_index, label) of stripped cells in the first rows that keep accepts."""
    nested = F.transform(
        rows,
        lambda r, i: F.filter(
            F.transform(r, lambda v, j: F.struct(i.cast("int").alias("row_index"), j.cast("int").alias("column_index"), strip(v).alias("label"))),
            lambda s: (s["label"] != "") & keep(s["label"]),
        ),
    )
    return nested


def period_labels(grid: Column) -> Column:
    return F.flatten(_labels(grid, F.slice(grid, 1, HEADER_ROWS), lambda t: t.rlike(PERIOD)))


def row_labels(grid: Column) -> Column:
    """The first non-numeric cell of each row that has one."""
    nested = _labels(grid, grid, lambda t: ~is_numeric(t))
    return F.transform(F.filter(nested, lambda r: F.size(r) > 0), lambda r: F.get(r, F.lit(0)))


def column_metadata(grid: Column, declaration: Column) -> Column:
    """Per column: its header path (non-numeric cells of the first rows), periods in it, unit and scale."""
    width = F.aggregate(grid, F.lit(0), lambda m, r: F.greatest(m, F.size(r)))
    carried = F.get(units_in(declaration), F.lit(0))
    heads = F.slice(grid, 1, HEADER_ROWS)
    cells = F.transform(
        F.when(width > 0, F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0)))).otherwise(F.array().cast("array<int>")),
        lambda c: F.struct(c.alias("c"), F.filter(F.transform(heads, lambda r: strip(F.get(r, c))), lambda t: t.isNotNull() & (t != "") & ~is_numeric(t)).alias("h")),
    )
    paths = F.transform(cells, lambda s: F.struct(s["c"].alias("c"), s["h"].alias("h"), F.array_join(F.array_distinct(s["h"]), " | ").alias("p")))
    units = F.transform(paths, lambda s: F.struct(s["c"].alias("c"), s["h"].alias("h"), s["p"].alias("p"), F.coalesce(F.get(units_in(s["p"]), F.lit(0)), carried).alias("u")))
    return F.transform(
        units,
        lambda s: F.struct(
            s["c"].cast("int").alias("column_index"), s["p"].alias("header_path"), F.filter(s["h"], lambda t: t.rlike(PERIOD)).alias("period_labels"),
            s["u"].alias("source_unit"), unit_scale(s["u"]).alias("scale_to_vnd"),
        ),
    )


def header_depth(grid: Column) -> Column:
    """Leading rows, of the first six, whose non-blank cells are all non-numeric; a blank row ends them."""
    head = F.transform(F.slice(grid, 1, HEADER_ROWS), lambda r: F.filter(F.transform(r, strip), lambda t: t != ""))
    good = F.transform(head, lambda r: (F.size(r) > 0) & F.forall(r, lambda t: ~is_numeric(t)))
    first_bad = F.array_position(good, F.lit(False))
    return F.when(first_bad > 0, first_bad - 1).otherwise(F.size(good)).cast("int")


def content_hash(grid: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the grid as compact JSON."""
    return F.substring(F.sha2(F.to_json(grid), 256), 1, 16)


def currency_hint(c: Column) -> Column:
    got = F.regexp_extract(F.coalesce(c, F.lit("")), f"({FOREIGN})", 1)
    return F.when(got != "", got)


def cell_text(grid: Column) -> Column:
    """Stripped non-blank cells joined by blanks."""
    return F.array_join(F.filter(F.transform(F.flatten(grid), strip), lambda t: t != ""), " ")


def _listed(values: Column, most: int) -> Column:
    return F.transform(F.slice(F.array_distinct(F.filter(values, lambda t: t.isNotNull() & (t != ""))), 1, most), lambda t: truncated(t))


def retrieval_text(ticker, company, year, variant, section, captions, units, periods, columns, rows) -> Column:
    """Labelled text of a table's schema: identity first, then structure, then row labels; empty parts are left out."""
    part = lambda name, arr, sep: F.when(F.size(arr) > 0, F.concat(F.lit(f"{name} "), F.array_join(arr, sep), F.lit(".")))
    named = lambda name, v, unknown: F.when(v.isNotNull() & ~v.cast("string").isin("", *unknown), F.concat(F.lit(f"{name} "), v.cast("string"), F.lit(".")))
    none = F.array().cast("array<string>")
    return F.concat_ws(
        " ",
        F.concat(F.lit("TICKER "), ticker, F.lit(".")),
        named("COMPANY", company, ()),
        named("YEAR", year, ("0",)),
        named("VARIANT", variant, ("unspecified",)),
        named("SECTION", section, ("unclassified",)),
        part("CAPTION", F.transform(F.coalesce(captions, none), lambda t: truncated(t)), " | "),
        part("UNIT", F.coalesce(units, none), ", "),
        part("PERIODS", _listed(F.transform(periods, lambda p: p["label"]), MAX_PERIODS), " | "),
        part("COLUMNS", _listed(F.transform(columns, lambda m: m["header_path"]), MAX_HEADERS), " | "),
        part("ROWS", _listed(F.transform(rows, lambda p: p["label"]), MAX_LABELS), " | "),
    )


def normalize(candidates: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Candidates (see extract.candidates) with all inferred metadata and table_key.

    companies (ticker, name) is a registry; its names enter the retrieval text.
    """
    grid = F.coalesce(F.col("grid"), F.array().cast("array<array<string>>"))
    df = candidates.withColumn("grid", grid).withColumns(report_parts(F.col("report_id")))
    df = df.withColumn("table_key", F.concat_ws("|", "report_id", F.col("line_position").cast("string")))
    df = df.withColumn("searchable_text", cell_text(F.col("grid")))
    own = units_in(F.concat_ws(" ", "searchable_text", F.array_join("caption_context", " ")))
    df = df.withColumns({
        "detected_units": F.when(F.size(own) > 0, own).otherwise(units_in(F.col("preceding_unit_declaration"))),
        "table_identity": F.concat_ws(" | ", "caption_context", "section_header"),
        "period_labels": period_labels(F.col("grid")),
        "column_metadata": column_metadata(F.col("grid"), F.col("preceding_unit_declaration")),
        "row_labels": row_labels(F.col("grid")),
        "currency_hint": currency_hint(F.col("searchable_text")),
        "header_depth": header_depth(F.col("grid")),
        "content_hash": content_hash(F.col("grid")),
    })
    if companies is None:
        df = df.withColumn("company_name", F.lit(None).cast("string"))
    else:
        df = df.join(companies.select("ticker", F.col("name").alias("company_name")), "ticker", "left")
    cols = ["ticker", "company_name", "year", "variant", "section_header", "caption_context", "detected_units", "period_labels", "column_metadata", "row_labels"]
    return df.withColumn("retrieval_text", retrieval_text(*map(F.col, cols))).drop("company_name")


def catalog_summary(tables: DataFrame) -> DataFrame:
    """One row: tables, reports, warnings, failures and anomalies of shape."""
    return tables.agg(
        F.count("*").alias("n_tables"), F.countDistinct("report_id").alias("n_reports"), F.count_if(F.col("status") == "parsed_with_warnings").alias("n_warned"),
        F.count_if(F.col("status") == "failed").alias("n_failed"), F.count_if(F.col("n_rows") > 200).alias("n_long"), F.count_if(F.col("n_cols") > 50).alias("n_wide"),
    )


def lookup(store: DataFrame, keys: DataFrame, key: str = "table_key") -> DataFrame:
    """Rows of the store for the wanted keys; a key that isn't there fails the job when it is reached."""
    wanted = keys.select(key).distinct()
    got = wanted.join(store.withColumn("_in_store", F.lit(True)), key, "left")
    missing = F.when(F.col("_in_store").isNull(), F.raise_error(F.concat(F.lit("not in the store: "), F.col(key))))
    return got.withColumn("_in_store", F.coalesce(F.col("_in_store"), missing)).filter("_in_store").drop("_in_store")
