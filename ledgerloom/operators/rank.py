"""Reranking, dense search and fusion of rankings; rankings are rows (query_id, doc_id, score, rank)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.text import let, tokens, truncated
from .blocks import matrix, unit_rows, vector_search
from .index import STOP_WORDS, ranked
from .normalize import MAX_LABELS

# Fixed values.
LABEL_WEIGHT, SECTION_BONUS, RELATED_PENALTY, RRF_K = 24.0, 1.0, 2.0, 60
PRIMARY = ("balance_sheet", "income_statement", "cash_flow")
#: Vectors of one block of queries that go to every task.
BLOCK_BYTES = 64 << 20
RELATED = "bên liên quan"


def token_set(text: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    return F.array_distinct(tokens(text, stop))


def label_sets(labels: Column, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Distinct tokens of each label; null labels count as none."""
    return F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda s: token_set(s, stop))


def label_text(labels: Column, most: int = MAX_LABELS) -> Column:
    """Labels as one text: each once, the first `most`, each bounded, joined by bars; what a sidecar of row labels holds."""
    return F.array_join(F.transform(F.slice(F.array_distinct(F.filter(F.coalesce(labels, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))), 1, most), lambda t: truncated(t)), " | ")


def label_overlap(q: Column, sets: Column) -> Column:
    """Largest Jaccard overlap of the question's token set with one label's; 0 where either is empty."""

    def over(own):
        def one(t):
            both = F.size(F.array_intersect(own, t))
            return F.coalesce(F.try_divide(both, F.size(own) + F.size(t) - both), F.lit(0.0))

        return F.array_max(F.transform(sets, one))

    return F.coalesce(let(q, over), F.lit(0.0))


def reranked(scored: DataFrame, question: str = "question", weight: float = LABEL_WEIGHT, bonus: float = SECTION_BONUS, penalty: float = RELATED_PENALTY) -> DataFrame:
    """scored (with question, q_set, label_sets, section, identity) with score + label overlap, section bonus and related-party penalty.

    q_set and label_sets are token sets, worked out once per question and once per table, before they meet.
    """
    asked = F.lower(F.col(question)).contains(RELATED)
    related = (F.col("section") == "notes") & F.lower(F.coalesce("identity", F.lit(""))).contains(RELATED) & ~asked
    extra = weight * label_overlap(F.col("q_set"), F.col("label_sets")) + F.when(F.col("section").isin(*PRIMARY), bonus).otherwise(0.0) - F.when(related, penalty).otherwise(0.0)
    return scored.withColumn("score", F.col("score") + extra)


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    """df with vector as unit-length doubles; a zero or null vector fails the job when it is reached."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    bad = F.raise_error(F.lit("a vector without direction")).cast("double")
    n = F.when(norm > 0, norm).otherwise(bad)
    return df.withColumn("_n", n).withColumn(vector, F.transform(v, lambda x: x / F.col("_n"))).drop("_n")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, scoped: bool = False, per_scope: bool = False, limit: int = BLOCK_BYTES) -> DataFrame:
    """Exact top k by cosine: (query_id, [scope], doc_id, score, rank).

    vectors: doc_id, vector, [scope]; queries: query_id, vector, [scope]. Queries go to the vectors in blocks of at most
    limit bytes, measured; each block reads the vectors once and multiplies matrices, and each task keeps the k best of
    every query (see `blocks`). A vector that is null, zero or of another length fails the job. per_scope: k per query and
    scope for queries of several scopes, else k per query.
    """
    on = ["scope"] if scoped else []
    named = queries.select("query_id", *on, "vector")
    n, width = named.agg(F.count("*"), F.max(F.size("vector"))).first()
    spark = vectors.sparkSession
    out = StructType([StructField("query_id", queries.schema["query_id"].dataType), StructField("doc_id", vectors.schema["doc_id"].dataType), StructField("score", DoubleType())])
    types = to_arrow_schema(out).types
    n_blocks = max(1, -(-(n or 0) * ((width or 1) * 8 + 64) // limit))
    number = StructType([StructField("number", LongType()), *named.select("query_id", *on).schema.fields])
    found = None
    for block in range(n_blocks):
        # A block is a bounded part of the stated queries.
        part = named if n_blocks == 1 else named.filter(F.pmod(F.xxhash64("query_id", *on), F.lit(n_blocks)) == block)
        t = part.toArrow()
        ids = list(zip(*[t.column(c).to_pylist() for c in ("query_id", *on)]))
        q = unit_rows(matrix(t.column("vector").combine_chunks())) if ids else np.empty((0, 1))
        scope_of = [x[1] for x in ids] if scoped else [None] * len(ids)
        groups = {s: np.array([i for i, x in enumerate(scope_of) if x == s]) for s in dict.fromkeys(scope_of) if s is not None or not scoped}
        sent = spark.sparkContext.broadcast(({s: (at, q[at]) for s, at in groups.items()}, np.arange(len(ids))))

        def run(batches, sent=sent):
            return vector_search(*sent.value, k, 6, (types[1], pa.int64()))(batches)

        best = vectors.select("doc_id", "vector", *on).mapInArrow(run, StructType([StructField("query_id", LongType()), *out.fields[1:]])).withColumnRenamed("query_id", "number")
        best = best.join(F.broadcast(spark.createDataFrame([(i, *x) for i, x in enumerate(ids)], number)), "number").select("query_id", *on, "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    return ranked(found, k, ("query_id", *(on if per_scope else ())), 6)


def rrf(rankings: DataFrame, k: int, constant: int = RRF_K) -> DataFrame:
    """Reciprocal-rank fusion of (source, query_id, doc_id, rank): score is the sum of 1 / (constant + rank)."""
    if constant <= 0 or k <= 0:
        raise ValueError("k and the constant must be positive")
    fused = rankings.groupBy("query_id", "doc_id").agg(F.sum(1.0 / (constant + F.col("rank"))).alias("score"))
    return ranked(fused, k)


def backfilled(primary: DataFrame, secondary: DataFrame, most: int) -> DataFrame:
    """primary (query_id, doc_id, rank) as it is, then up to most unseen entries of secondary in its order."""
    s = secondary.groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank")).join(primary.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    s = s.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("rank", "doc_id"))).filter(F.col("r") <= most)
    last = primary.groupBy("query_id").agg(F.max("rank").alias("last"))
    s = s.join(last, "query_id", "left").select("query_id", "doc_id", (F.coalesce("last", F.lit(0)) + F.col("r")).alias("rank"), F.lit("secondary").alias("source"))
    return primary.select("query_id", "doc_id", "rank", F.lit("primary").alias("source")).unionByName(s)
