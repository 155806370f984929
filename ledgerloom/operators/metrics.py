"""Retrieval and answer metrics, per query and averaged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def prf(retrieved: DataFrame, relevant: DataFrame) -> DataFrame:
    """Precision, recall and F2 of each query in relevant, over sets of keys.

    retrieved and relevant: (query_id, key). A query without a retrieved or relevant key scores 0.
    """
    got, want = retrieved.select("query_id", "key").distinct(), relevant.select("query_id", "key").distinct()
    both = want.withColumn("w", F.lit(1)).join(got.withColumn("g", F.lit(1)), ["query_id", "key"], "full")
    n = both.groupBy("query_id").agg(F.count("g").alias("n_retrieved"), F.count(F.when(F.col("key").isNotNull(), F.col("w"))).alias("n_relevant"), F.count_if((F.col("w") == 1) & (F.col("g") == 1)).alias("n_correct"), F.max("w").alias("asked"))
    return scored(n.filter("asked = 1").drop("asked"))


def scored(n: DataFrame) -> DataFrame:
    """n (n_retrieved, n_relevant, n_correct) with precision, recall and F2."""
    zero = F.lit(0.0)
    p = F.coalesce(F.try_divide("n_correct", "n_retrieved"), zero)
    r = F.coalesce(F.try_divide("n_correct", "n_relevant"), zero)
    n = n.withColumn("precision", p).withColumn("recall", r)
    return n.withColumn("f2", F.coalesce(F.try_divide(5.0 * F.col("precision") * F.col("recall"), 4.0 * F.col("precision") + F.col("recall")), zero))


def macro(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Unweighted means over queries, per group if given."""
    return scores.groupBy(*(by or [])).agg(F.count("*").alias("n_queries"), *[F.avg(c).alias(f"{c}_macro") for c in ("precision", "recall", "f2")])


def breakdown(scores: DataFrame, first: str, second: str) -> DataFrame:
    """Means by each of two attributes, in one pass of grouping sets."""
    g = scores.groupingSets([[first], [second]], first, second)
    return g.agg(F.count("*").alias("n_queries"), F.avg("recall").alias("recall_macro"), F.avg("f2").alias("f2_macro"))


def reciprocal_rank(ranked: DataFrame, relevant: DataFrame, k: int = 5) -> DataFrame:
    """1 / rank of the first relevant key among the first k, 0 for none; one row per query in relevant."""
    want = relevant.select("query_id", "key").distinct()
    hit = ranked.filter(F.col("rank") <= k).join(want, ["query_id", "key"], "left_semi").groupBy("query_id").agg((1.0 / F.min("rank")).alias("rr"))
    return want.select("query_id").distinct().join(hit, "query_id", "left").select("query_id", F.coalesce("rr", F.lit(0.0)).alias("rr"))


def sheet(ranked: DataFrame, relevant: DataFrame, document: Column, k: int = 5) -> DataFrame:
    """Macro precision, recall, F2 and reciprocal rank by tables and by documents, a row each (level).

    ranked: query_id, key, rank. document: the document of a key. A document's rank is that of its first table; as in the
    list it comes from, tables of one document before it keep their places.
    """
    rows = []
    for level, of in (("tables", F.col("key")), ("documents", document)):
        got, want = ranked.withColumn("key", of), relevant.withColumn("key", of)
        m = macro(prf(got, want))
        rr = reciprocal_rank(got, want, k).agg(F.avg("rr").alias("mrr"))
        rows.append(m.join(F.broadcast(rr)).select(F.lit(level).alias("level"), "*"))  # one row each
    return rows[0].unionByName(rows[1])


def at_ks(ranked: DataFrame, relevant: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """Macro scores of the first k keys of each query for each k; keys meet once, and only counts are kept for each k."""
    got = ranked.groupBy("query_id", "key").agg(F.min("rank").alias("rank"))
    want = relevant.select("query_id", "key").distinct().withColumn("w", F.lit(1))
    cuts = [F.struct(F.lit(k).alias("k"), F.count_if(F.col("rank") <= k).alias("n_retrieved"), F.count_if((F.col("w") == 1) & (F.col("rank") <= k)).alias("n_correct")) for k in ks]
    n = want.join(got, ["query_id", "key"], "full").groupBy("query_id").agg(F.array(*cuts).alias("cuts"), F.count(F.when(F.col("key").isNotNull(), F.col("w"))).alias("n_relevant"), F.max("w").alias("asked"))
    n = n.filter("asked = 1").select("query_id", "n_relevant", F.inline("cuts"))
    return macro(scored(n), ["k"])


def outcome(executed: Column, stage: Column, answer: Column, expected: Column) -> Column:
    """What became of a question: correct, executed_wrong, executed_unscored, or the stage that failed."""
    right = F.when(expected.isNotNull() & answer.isNotNull(), close(answer, expected))
    return (
        F.when(executed & right, "correct").when(executed & right.isNotNull(), "executed_wrong").when(executed, "executed_unscored").when(stage == "generation", "generation_or_validation_failed")
        .when(stage == "render", "render_failed").when(stage == "execution", "execution_crashed").otherwise("not_executed_unknown")
    )


_DIFFERENCE = r"\((-?[0-9]+(?:\.[0-9]+)?)\s*-\s*(-?[0-9]+(?:\.[0-9]+)?)\)\s*/\s*([0-9.]+(?:e[0-9]+)?)(?:\s*\*\s*([0-9.]+))?"
_QUOTIENT = r"(-?[0-9]+(?:\.[0-9]+)?)\s*(?:VND|VNĐ)?\s*/\s*([0-9.]+e[0-9]+)"


def derived(text: Column) -> Column:
    """The value of the last `(a - b) / c [* d]` in a text, else of the last `a [VND] / 1eN`, else null."""
    last = lambda p, n: F.try_element_at(F.regexp_extract_all(text, F.lit(p), n), F.lit(-1)).try_cast("double")
    diff = F.try_divide(last(_DIFFERENCE, 1) - last(_DIFFERENCE, 2), last(_DIFFERENCE, 3)) * F.coalesce(last(_DIFFERENCE, 4), F.lit(1.0))
    return F.coalesce(diff, F.try_divide(last(_QUOTIENT, 1), last(_QUOTIENT, 2)))


def derivation_status(expected: Column, text: Column) -> Column:
    """pass, fail, no_formula or no_expected_answer of an expected answer against the formula written beside it."""
    v = derived(text)
    return F.when(expected.isNull(), "no_expected_answer").when(v.isNull(), "no_formula").when(close(v, expected), "pass").otherwise("fail")


def zero_credit(value: Column, scored: Column, total: Column) -> Column:
    """A mean over the scored queries as one over all, the others counting 0; fails if there are fewer in all."""
    return F.when(total >= scored, value * scored / total).otherwise(F.raise_error(F.lit("fewer queries in all than scored")).cast("double"))


def close(a: Column, b: Column, absolute: float = 1e-6, relative: float = 1e-6) -> Column:
    """Whether two numbers agree within the larger of both tolerances; null and NaN agree with nothing."""
    most = F.greatest(F.abs(a), F.abs(b))
    near = (F.abs(a - b) <= F.greatest(relative * most, F.lit(absolute))) & (most < float("inf"))
    return F.coalesce(((a == b) | near) & ~F.isnan(a) & ~F.isnan(b), F.lit(False))


def accuracy(answers: DataFrame, by: list[str]) -> DataFrame:
    """Per group: answers, those that were computed, those that are right. answers: answer, expected."""
    right = close(F.col("answer"), F.col("expected"))
    return answers.groupBy(*by).agg(
        F.count("*").alias("n"), F.count("answer").alias("n_executed"), F.count_if(right).alias("n_right"), (F.count_if(right) / F.count("*")).alias("accuracy")
    )


def first_failure(df: DataFrame) -> DataFrame:
    """stage: where a question first went wrong. df: has_gold, in_retrieved, in_linked, answer, expected."""
    stage = (
        F.when(~F.col("has_gold"), "unscored").when(~F.col("in_retrieved"), "retrieval").when(~F.col("in_linked"), "schema_linking")
        .when(F.col("answer").isNull(), "generation").when(F.col("expected").isNull(), "executed").when(close(F.col("answer"), F.col("expected")), "correct").otherwise("correctness")
    )
    return df.withColumn("stage", stage)
