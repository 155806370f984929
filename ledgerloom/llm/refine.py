"""Records that are the same but for formatting, found by progressive partition refinement.

All records are first partitioned by cheap invariants that no formatting difference changes: the
report, the shape of the grid, the stripped length and a letter histogram. Only classes with several
members are refined by the costlier key, the sorted columns of normalized cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import let
from ..session import attach_groups, join_checked, settle

#: White space of any kind and punctuation.
IGNORED = r"[\s\p{Z}\p{P}\x{85}]+"
#: Characters counted for the histogram.
COUNTED = "0123456789aeiouhntc"


def dressed_down(c: Column) -> Column:
    """Text without white space, punctuation and letter case; null as empty."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), IGNORED, "")


def invariants(report: Column, grid: Column) -> Column:
    """A 64-bit key of what stays when cells are reformatted and columns change places."""
    width = F.aggregate(grid, F.lit(0), lambda m, r: F.greatest(m, F.coalesce(F.size(r), F.lit(0))))
    text = dressed_down(F.array_join(F.transform(grid, lambda r: F.array_join(r, "")), ""))
    counts = [F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit(""))) for ch in COUNTED]
    return F.xxhash64(dressed_down(report), F.size(grid), width, F.length(text), *counts)


def column_key(report: Column, grid: Column) -> Column:
    """MD5 of the report and the sorted columns, each the normalized cells from top to bottom; short rows are padded with empty cells."""
    width = F.aggregate(grid, F.lit(0), lambda m, r: F.greatest(m, F.coalesce(F.size(r), F.lit(0))))

    def columns(tidy):
        return F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda c: F.array_join(F.transform(tidy, lambda r: F.coalesce(F.get(r, c), F.lit(""))), "\u0001"))

    # The cells are normalized once, not once per column.
    cols = let(F.transform(grid, lambda r: F.transform(r, dressed_down)), columns)
    return F.md5(F.concat_ws("\u0002", dressed_down(report), F.size(grid).cast("string"), width.cast("string"), F.array_join(F.array_sort(cols), "\u0002")))


def copies(tables: DataFrame) -> DataFrame:
    """group_id (smallest record_id), record_id and n_copies of every record in a group of two or more.

    tables: record_id (unique), report_id, grid. Null and empty grids belong to no group; a null report
    counts as an empty one; null cells as empty ones. Other columns are ignored. Keys of 64 and 128 bits
    stand for the texts, so no text is shuffled unless the multi-member classes outgrow a broadcast.
    """
    t = tables.filter(F.size("grid") > 0).select("record_id", "report_id", "grid")
    first = settle(t.select("record_id", invariants(F.col("report_id"), F.col("grid")).alias("k")))
    several = settle(first.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1"))
    left = settle(attach_groups(first, several, ["k"], "n").select("record_id"))
    # The second key is computed inside the surviving classes only.
    second = join_checked(t, left, "record_id", "left_semi", 24)
    second = settle(second.select("record_id", column_key(F.col("report_id"), F.col("grid")).alias("key")))
    groups = settle(second.groupBy("key").agg(F.min("record_id").alias("group_id"), F.count("*").alias("n_copies")).filter("n_copies > 1"))
    return attach_groups(second, groups, ["key"], "n_copies").select("group_id", "record_id", "n_copies")


def collapsed(tables: DataFrame) -> DataFrame:
    """One row per distinct record: the record_id kept (smallest of its group) and n_copies (1 where there is no other).

    Records with a null or empty grid are each kept as they are.
    """
    c = settle(copies(tables))
    dropped = c.filter("group_id <> record_id").select("record_id")
    counts = c.filter("group_id = record_id").select("record_id", "n_copies")
    kept = tables.select("record_id", "report_id", "table_key", "content_hash").join(dropped, "record_id", "left_anti")
    return kept.join(counts, "record_id", "left").withColumn("n_copies", F.coalesce("n_copies", F.lit(1).cast("bigint")))
