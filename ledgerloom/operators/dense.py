"""Dense retrieval: texts encoded by a caller's encoder, vectors stored as a table, ranked in the same scopes as the sparse search."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from ..session import join_checked
from . import index as I, rank as R
from .blocks import unit_rows
from .retrieve import EVERYWHERE, question_scopes, table_scopes

#: texts to a matrix of one row per text. It goes to the workers, so what it loads it loads there, once per task.
Encoder = Callable[[list[str]], np.ndarray]


def encoded(df: DataFrame, text: str, encoder: Encoder, batch: int = 256, out: str = "vector") -> DataFrame:
    """df plus unit vectors of column text, in batches of at most `batch` texts; null counts as the empty text.

    A result of another number of rows or a vector without direction fails the job.
    """
    if batch <= 0:
        raise ValueError("a batch has one text at least")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text].fillna("").tolist()
            parts = [np.asarray(encoder(texts[i : i + batch]), dtype=np.float64) for i in range(0, len(texts), batch)]
            if any(p.ndim != 2 for p in parts) or sum(map(len, parts)) != len(texts):
                raise ValueError("the encoder must give one vector per text")
            pdf[out] = [v for p in parts for v in unit_rows(p).astype(np.float32)]
            yield pdf

    return df.mapInPandas(run, StructType([*df.schema.fields]).add(out, ArrayType(FloatType())))


def build_vectors(tables: DataFrame, encoder: Encoder, path: str, companies: DataFrame | None = None, batch: int = 256) -> DataFrame:
    """Vectors of all tables under path, with what scopes them: doc_id, ticker, year, variant, vector.

    The text is the schema text, or with companies the text that the sparse index has. A stored index is used again if it is
    of exactly the same documents, else it is written anew.
    """
    spark = tables.sparkSession
    about = ["ticker", "year", "variant"]
    if companies is None:
        t = tables.select(F.col("table_key").alias("doc_id"), *about, F.col("retrieval_text").alias("text"))
    else:
        named = join_checked(tables.select("table_key", *about, "searchable_text"), companies.select("ticker", "name"), "ticker", "left", 100)
        t = named.select(F.col("table_key").alias("doc_id"), *about, I.enriched([F.col("ticker"), F.col("name"), F.col("year")], F.col("searchable_text")).alias("text"))
    try:
        stored = load_vectors(spark, path)
        same = stored.select("doc_id").exceptAll(t.select("doc_id")).isEmpty() and t.select("doc_id").exceptAll(stored.select("doc_id")).isEmpty()
    except Exception:  # nothing is stored there
        same = False
    if not same:
        encoded(t, "text", encoder, batch).drop("text").write.mode("overwrite").parquet(path)
    return load_vectors(spark, path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dense_rankings(questions: DataFrame, companies: DataFrame, vectors: DataFrame, encoder: Encoder | None = None, k: int = 10) -> DataFrame:
    """(id, table_key, score, rank): the k nearest tables of each question over all its scopes together.

    Scopes are those of the sparse search: the companies a question names, its year if it names exactly one, its variant; a
    question without a company searches everywhere, one whose scope is empty has no row. vectors: doc_id, ticker, year,
    variant, vector. questions: id, question, and vector unless an encoder is given.
    """
    q = questions.dropDuplicates(["id"])
    q = encoded(q, "question", encoder) if encoder is not None else q
    s = question_scopes(q.select("id", "question"), companies).select("id", "scope")
    asked = s.join(q.select("id", "vector"), "id").withColumnRenamed("id", "query_id")
    kept = vectors.select("doc_id", F.explode(table_scopes()).alias("scope"), "vector")
    docs = join_checked(kept, s.select("scope").distinct(), "scope", "left_semi", 64)
    got = R.nearest(docs, asked, k, scoped=True)
    return got.select(F.col("query_id").alias("id"), F.col("doc_id").alias("table_key"), "score", "rank")


def fused(sparse: DataFrame, dense: DataFrame, most: int = 10) -> DataFrame:
    """sparse rankings (id, table_key, rank) kept, up to `most` new tables of dense appended; both must cover the same questions.

    A question that only one side has fails the job with its id.
    """
    a, b = sparse.select("id").distinct().withColumn("a", F.lit(True)), dense.select("id").distinct().withColumn("b", F.lit(True))
    odd = a.join(b, "id", "full").filter("a is null or b is null").limit(1).collect()
    if odd:
        raise ValueError(f"only one of the rankings has question {odd[0].id}")
    named = lambda d: d.select(F.col("id").alias("query_id"), F.col("table_key").alias("doc_id"), "rank")
    got = R.backfilled(named(sparse), named(dense), most)
    return got.select(F.col("query_id").alias("id"), F.col("doc_id").alias("table_key"), "rank", "source")


def write_npy(vectors: DataFrame, path: str, most: int = 1_000_000) -> int:
    """Vectors as one .npy matrix with a JSON list of their ids beside it, for tools that want files; at most `most` rows."""
    import json

    t = vectors.select("doc_id", "vector").limit(most + 1).toArrow()
    if t.num_rows > most:
        raise ValueError(f"more than {most} vectors are no single file")
    column = t.column("vector").combine_chunks()
    np.save(path, column.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) if t.num_rows else np.empty((0, 1), np.float32))
    with open(f"{path}.json", "w", encoding="utf-8") as f:
        json.dump(t.column("doc_id").to_pylist(), f, ensure_ascii=False)
    return t.num_rows


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, vector) of a matrix and ids that `write_npy` wrote."""
    import json

    with open(f"{path}.json", encoding="utf-8") as f:
        ids = json.load(f)
    m = np.load(path)
    if len(ids) != len(m):
        raise ValueError("as many ids as vectors are needed")
    return spark.createDataFrame(pa.table({"doc_id": pa.array(ids), "vector": pa.array(list(m.astype(np.float32)), pa.list_(pa.float32()))}))


__all__ = ["EVERYWHERE", "Encoder", "build_vectors", "dense_rankings", "encoded", "fused", "load_vectors", "read_npy", "write_npy"]
