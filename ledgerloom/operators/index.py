"""BM25 as relations: postings, document frequencies and lengths per scope, scored by equi-joins on terms."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions.text import tokens
from ..session import join_checked, settle
from .blocks import term_search

# Fixed values.
K1, B, IDENTITY_BOOST = 1.5, 0.75, 5
#: Terms of one block of queries that go to every task.
BLOCK_BYTES = 64 << 20
STOP_WORDS = tuple(
    """
    là của và các những này đó cho để với trong trên dưới khi đã sẽ có bao nhiêu
    công ty một được tại về từ đến theo như sau trước hay hoặc thì mà nào gì
    năm ngày tháng đơn vị tính vnd đồng cổ phần
    """.split()
)


def enriched(identity: list[Column], text: Column, boost: int = IDENTITY_BOOST) -> Column:
    """Indexed text of a table: its identity repeated boost times, then its cells."""
    head = F.concat(*[x for c in identity for x in (F.coalesce(c.cast("string"), F.lit("")), F.lit(" "))])
    return F.concat(F.repeat(head, boost), F.coalesce(text, F.lit("")))


def tokenized(docs: DataFrame, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """(scope, doc_id, t): the tokens of docs (scope, doc_id, text); docs that have t already keep it."""
    return docs.select("scope", "doc_id", "t") if "t" in docs.columns else docs.select("scope", "doc_id", tokens(F.col("text"), stop).alias("t"))


def postings(docs: DataFrame, stop: tuple[str, ...] = STOP_WORDS, only: DataFrame | None = None) -> DataFrame:
    """docs (scope, doc_id, text) to (scope, doc_id, term, f, dl); texts without a token give no row.

    only (scope, term) keeps the postings of those terms; they are dropped before the aggregate's
    shuffle, by a broadcast while the terms are few.
    """
    d = tokenized(docs, stop)
    words = d.select("scope", "doc_id", F.size("t").alias("dl"), F.explode("t").alias("term"))
    if only is not None:
        words = join_checked(words, only, ["scope", "term"], "left_semi", 48)
    return words.groupBy("scope", "doc_id", "term", "dl").agg(F.count("*").alias("f"))


def scope_stats(docs: DataFrame, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """Per scope the number of documents and their mean length; documents without a token count."""
    d = tokenized(docs, stop).select("scope", F.size("t").alias("dl"))
    return d.groupBy("scope").agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))


def term_stats(posts: DataFrame, stats: DataFrame) -> DataFrame:
    """Per scope and term: documents that hold it and its inverse document frequency, never negative."""
    df = posts.groupBy("scope", "term").agg(F.count("*").alias("n_t"))
    idf = F.ln(1.0 + (F.col("n_docs") - F.col("n_t") + 0.5) / (F.col("n_t") + 0.5))
    return df.join(stats, "scope").withColumn("idf", idf)


def query_terms(queries: DataFrame, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """queries (query_id, scope, text) to (query_id, scope, term, qf); repeats of a term count."""
    q = queries.select("query_id", "scope", F.explode(tokens(F.col("text"), stop)).alias("term"))
    return q.groupBy("query_id", "scope", "term").agg(F.count("*").alias("qf"))


def bm25(docs: DataFrame, queries: DataFrame, stop: tuple[str, ...] = STOP_WORDS, k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, scope, doc_id, score) of every document that shares a term with the query in its scope.

    Statistics hold inside each scope, so scores of different scopes don't compare. Postings are first
    reduced to terms that some query asks for in that scope.
    """
    q = query_terms(queries, stop)
    posts = postings(docs, stop, q.select("scope", "term").distinct())
    terms = term_stats(posts, scope_stats(docs, stop))
    weight = F.col("idf") * F.col("f") * (k1 + 1.0) / (F.col("f") + k1 * (1.0 - b + b * F.col("dl") / F.col("avgdl")))
    weighted = posts.join(terms, ["scope", "term"]).select("scope", "term", "doc_id", weight.alias("w"))
    # A block of queries small enough to be sent to the postings leaves them where they lie.
    met = join_checked(weighted, q, ["scope", "term"], "inner", 64)
    return met.groupBy("query_id", "scope", "doc_id").agg(F.sum(F.col("qf") * F.col("w")).alias("score"))


def top_documents(docs: DataFrame, queries: DataFrame, k: int, stop: tuple[str, ...] = STOP_WORDS, k1: float = K1, b: float = B, digits: int = 9, limit: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, scope, doc_id, score, rank): the k best documents of each query, as `ranked(bm25(...), k, by query and scope)` gives.

    While the queries' terms are below limit bytes they go to the documents, which stay where they lie: one pass counts the
    documents that hold each asked term, one scores (see `blocks`). More queries are scored by shuffle joins. A query has
    one scope.
    """
    q = settle(query_terms(queries, stop))
    n, width = q.agg(F.count("*"), F.max(F.octet_length(F.concat_ws("", F.col("query_id").cast("string"), F.col("scope").cast("string"), "term")))).first()
    if n == 0 or n * (width + 64) > limit:
        return ranked(bm25(docs, queries, stop, k1, b), k, ("query_id", "scope"), digits)
    spark = docs.sparkSession
    asked = q.select("scope", "term").distinct().unionByName(q.select("scope", F.lit("").alias("term")).distinct()).toPandas()
    asked["number"] = np.arange(len(asked), dtype=np.int32)
    numbers = F.broadcast(spark.createDataFrame(asked, StructType([*q.select("scope", "term").schema.fields, StructField("number", IntegerType())])))
    docs = join_checked(docs, q.select("scope").distinct(), "scope", "left_semi", 64)
    held = tokenized(docs, stop)
    # The empty term stands for the document itself.
    seen = held.select("scope", F.size("t").alias("dl"), F.explode(F.concat(F.array_distinct("t"), F.array(F.lit("")))).alias("term"))
    count = {r.number: (r.n, r.s) for r in seen.join(numbers, ["scope", "term"]).groupBy("number").agg(F.count("*").alias("n"), F.sum("dl").alias("s")).collect()}
    pdf = q.toPandas()
    ids = np.array(sorted(set(zip(pdf["query_id"], pdf["scope"])), key=str), dtype=object).reshape(-1, 2)
    place = {tuple(x): i for i, x in enumerate(ids)}
    number = {(s, t): i for s, t, i in asked.itertuples(index=False)}
    weights: dict = {}
    lengths: dict = {}
    for scope, part in pdf.groupby("scope", sort=False):
        total, words = count.get(number[scope, ""], (0, 0))
        if not total:
            continue
        at = np.array(sorted({place[x, scope] for x in part["query_id"]}))
        local = {g: i for i, g in enumerate(at)}
        by_term: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for term, hits in part.groupby("term", sort=False):
            holds = count.get(number[scope, term], (0, 0))[0]
            idf = math.log(1.0 + (total - holds + 0.5) / (holds + 0.5))
            by_term[number[scope, term]] = np.array([local[place[x, scope]] for x in hits["query_id"]]), hits["qf"].to_numpy(float) * idf
        weights[scope], lengths[scope] = (len(at), at, by_term), max(words / total, 1e-300)
    rows = held.select("scope", "doc_id", F.size("t").cast("double").alias("dl"), F.explode("t").alias("term")).join(numbers, ["scope", "term"]).select("scope", "doc_id", "dl", F.col("number").alias("term"))
    kinds = {f.name: f.dataType for f in docs.schema} | {f.name: f.dataType for f in q.schema}
    arrow = to_arrow_schema(StructType([StructField("d", kinds["doc_id"]), StructField("q", kinds["query_id"])])).types
    sent = spark.sparkContext.broadcast((weights, lengths, ids[:, 0]))

    def run(batches):
        return term_search(*sent.value[:2], sent.value[2], k, digits, k1, b, tuple(arrow))(batches)

    out = StructType([StructField("query_id", kinds["query_id"]), StructField("doc_id", kinds["doc_id"]), StructField("score", DoubleType())])
    best = rows.mapInArrow(run, out)
    scoped = best.join(F.broadcast(q.select("query_id", "scope").distinct()), "query_id")
    return ranked(scoped, k, ("query_id", "scope"), digits).select("query_id", "scope", "doc_id", "score", "rank")


def ranked(scored: DataFrame, k: int | None, by: tuple[str, ...] = ("query_id",), digits: int = 9) -> DataFrame:
    """Adds rank by descending score, ties by doc_id as text; keeps the first k.

    Scores are rounded to digits first, so that sums in another order can't change a tie.
    """
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").cast("string"))
    out = scored.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(w))
    return out if k is None else out.filter(F.col("rank") <= k)
