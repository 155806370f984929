"""Queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import settle, table
from . import mentions, mixing, oneform, packing, reading, refine
from .tokens import sized

#: Share of a window that may bear loss in the instruction packs.
LOSS_SHARE = 0.9


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    items = oneform.table_items(table(spark, sf, "norm_tables")).unionByName(oneform.question_items(table(spark, sf, "dev_questions")))
    return oneform.look_alike_pairs(items)


def p1_question_forms(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "dev_questions").select("id", "set_name", "question")
    return oneform.with_form(q, "question", "form").select("id", "set_name", "form")


def p1_table_forms(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "norm_tables")
    items = oneform._labels(t).unionByName(oneform._cells(t))
    return oneform.with_form(items, "text", "form").select("field", "key", "form")


def p1_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Every text that looks like another one, with its class and the number of its links."""
    items = oneform.table_items(table(spark, sf, "norm_tables")).unionByName(oneform.question_items(table(spark, sf, "dev_questions")))
    return oneform.look_alike_classes(items)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.map_mentions(table(spark, sf, "dev_questions"), table(spark, sf, "companies"))


def p3_named(spark: SparkSession, sf: str) -> DataFrame:
    found = p3_found(spark, sf)
    names = table(spark, sf, "companies").select("ticker", "name")
    return found.join(names, "ticker", "left").select("id", "ticker", "name", (F.col("ticker") == mentions.NONE).alias("unmatched"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return refine.copies(table(spark, sf, "norm_tables")).select("group_id", "record_id")


def p5_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return refine.collapsed(table(spark, sf, "norm_tables"))


def p7_windows(spark: SparkSession, sf: str) -> DataFrame:
    return packing.windows(sized(table(spark, sf, "documents")), table(spark, sf, "pack_sizes"))


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill(p7_windows(spark, sf), table(spark, sf, "pack_sizes"))


def p7_instruction_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of which at most LOSS_SHARE may bear loss, as for instruction data: the first line is the context of the rest."""
    return packing.windows(sized(table(spark, sf, "documents")), table(spark, sf, "pack_sizes"), packing.Limits(loss_share=LOSS_SHARE))


def p7_instruction_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill(p7_instruction_windows(spark, sf), table(spark, sf, "pack_sizes"))


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(sized(table(spark, sf, "documents"), ("source",)), table(spark, sf, "mix_targets"))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_targets")
    sizes = settle(sized(table(spark, sf, "documents"), ("source",)))
    return mixing.shares(mixing.mixture(sizes, targets), mixing.plan(sizes, targets))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return reading.reading_levels(table(spark, sf, "documents"), table(spark, sf, "level_samples")).select("doc_id", "level")


def p9_profile(spark: SparkSession, sf: str) -> DataFrame:
    return reading.reading_levels(table(spark, sf, "documents"), table(spark, sf, "level_samples"))


_ALL = (
    p1_found, p1_question_forms, p1_table_forms, p1_classes, p3_found, p3_named, p5_found, p5_collapsed, p7_windows, p7_fill, p7_instruction_windows, p7_instruction_fill, p8_mixture, p8_shares, p9_found, p9_profile,
)
QUERIES = {f.__name__: f for f in _ALL}

_TIDY = r"regexp_replace(lower(coalesce({}, '')), '[\s\p{{Z}}\p{{P}}]+', '', 'g')"
_P5 = f"""
WITH r AS (SELECT record_id, {_TIDY.format("report_id")} AS rep, grid, len(grid) AS h, list_max(list_transform(grid, lambda x: len(x))) AS w FROM norm_tables WHERE len(grid) > 0),
c AS (SELECT record_id, rep, h, list_sort(list_transform(range(greatest(w, 1)), lambda i: list_aggregate(list_transform(grid, lambda x: {_TIDY.format("x[i + 1]")}), 'string_agg', chr(1)))) AS cols FROM r),
g AS (SELECT *, min(record_id) OVER (PARTITION BY rep, h, cols) AS group_id, count(*) OVER (PARTITION BY rep, h, cols) AS n_copies FROM c)
"""
ORACLE = {
    "p5_found": _P5 + "SELECT group_id, record_id FROM g WHERE n_copies > 1",
    "p5_collapsed": _P5
    + """SELECT record_id, report_id, table_key, content_hash, n_copies FROM g JOIN (SELECT record_id, report_id, table_key, content_hash FROM norm_tables) USING (record_id) WHERE group_id = record_id
UNION ALL SELECT record_id, report_id, table_key, content_hash, 1 FROM norm_tables WHERE coalesce(len(grid), 0) = 0""",
}
