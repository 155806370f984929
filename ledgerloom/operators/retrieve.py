"""Tables ranked for questions: scoped search, rerank and top-ups per concept, for all questions at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import join_checked, settle
from . import index as I, rank as R, scope as S
from .normalize import MAX_LABELS
from .together import MOST_TOGETHER, best_in_scopes

#: Scope of questions that name no company on the list.
EVERYWHERE = "*"


def question_scopes(questions: DataFrame, companies: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """(id, question, scope, n_companies): a row per company a question names, or one with scope EVERYWHERE.

    named (id, ticker) gives the companies of questions that were resolved elsewhere; entries that aren't on the list are left
    out, and by default `scope.resolved_tickers` resolves them. A scope is company|year|variant; the year counts only if exactly one is named, the variant only if one is.
    """
    q = questions.select("id", "question").dropDuplicates(["id"])
    if named is None:
        q = q.join(S.resolved_tickers(questions, companies), "id")
    else:
        known = join_checked(named.select("id", "ticker"), companies.select("ticker"), "ticker", "left_semi", 16)
        q = q.join(known.groupBy("id").agg(F.array_sort(F.collect_set("ticker")).alias("tickers")), "id", "left").withColumn("tickers", F.coalesce("tickers", F.array().cast("array<string>")))
    asked = S.years(F.col("question"))
    year = F.when(F.size(asked) == 1, F.get(asked, F.lit(0)).cast("string"))
    q = q.withColumn("n_companies", F.size("tickers")).withColumn("ticker", F.explode_outer("tickers"))
    scope = F.concat_ws("|", "ticker", F.coalesce(year, F.lit("*")), F.coalesce(S.variant(F.col("question")), F.lit("*")))
    return q.select("id", "question", "n_companies", F.when(F.col("ticker").isNull(), EVERYWHERE).otherwise(scope).alias("scope"))


def table_scopes() -> Column:
    """All scopes that a table (ticker, year, variant) stands in: everywhere, and its company with or without year and variant."""
    year, any_ = F.col("year").cast("string"), F.lit("*")
    own = [F.concat_ws("|", "ticker", y, v) for y in (any_, year) for v in (any_, F.col("variant"))]
    return F.array_compact(F.array_distinct(F.array(F.lit(EVERYWHERE), *[F.when(F.col("ticker").isNotNull(), c) for c in own])))


def scoped_documents(tables: DataFrame, companies: DataFrame) -> DataFrame:
    """(doc_id, scopes, t, label_sets, section, identity) of the tables, each table's tokens worked out once; a scope without tables never falls back."""
    t = tables.select("table_key", "ticker", "year", "variant", "searchable_text", "row_labels", "section_header", "table_identity")
    t = join_checked(t, companies.select("ticker", "name"), "ticker", "left", 100)
    text = I.enriched([F.col("ticker"), F.col("name"), F.col("year")], F.col("searchable_text"))
    labels = R.label_sets(F.slice(F.transform("row_labels", lambda x: x["label"]), 1, MAX_LABELS))
    return t.select(F.col("table_key").alias("doc_id"), table_scopes().alias("scopes"), I.tokens(text, I.STOP_WORDS).alias("t"), labels.alias("label_sets"), F.col("section_header").alias("section"), F.col("table_identity").alias("identity"))


def ranked_tables(questions: DataFrame, tables: DataFrame, companies: DataFrame, k: int = 10, most: int = S.TICKER_CAP, named: DataFrame | None = None, together: int = MOST_TOGETHER) -> DataFrame:
    """(id, pos, scope, table_key, score, part): the tables for each question, company after company.

    Per company the k best tables by BM25 in its scope, label overlap and section, then, where the
    question names two concepts or more, the best new ones for each concept, up to `most` in all. Scores
    of different companies don't compare. A question without a company searches everywhere; only the
    best max(20 k, 200) are reranked there. tables: one row per table_key. named: see `question_scopes`.
    together: see `together.MOST_TOGETHER`.
    """
    scopes = settle(question_scopes(questions, companies, named))
    wanted = scopes.join(S.concepts(questions.select("id", "question").dropDuplicates(["id"])), "id")
    tops = F.when((F.size("concepts") >= 2) & (F.col("scope") != EVERYWHERE), F.col("concepts")).otherwise(F.array().cast("array<string>"))
    q = wanted.select("id", "scope", "n_companies", F.posexplode(F.concat(F.array("question"), tops)).alias("part", "text"))
    q = settle(q.withColumn("query_id", F.concat_ws("#", F.col("id").cast("string"), F.col("part").cast("string"))))
    # A part after the first has its own, smaller budget; the best for the larger one hold it.
    deep = max(k, S.CONCEPT_BUDGET)
    found = best_in_scopes(scoped_documents(tables, companies), q.select("query_id", "scope", "text"), deep, EVERYWHERE, max(20 * k, 200), most=together)
    scored = found.join(q.select("query_id", "scope", "id", "part", "n_companies"), ["query_id", "scope"])
    budget = F.when(F.col("part") == 0, k).otherwise(S.concept_budget(F.col("n_companies")))
    best = I.ranked(scored, None, ("query_id", "scope")).filter(F.col("rank") <= budget)
    first = Window.partitionBy("id", "scope", "doc_id").orderBy("part")
    best = best.withColumn("_f", F.row_number().over(first)).filter("_f = 1")
    best = best.withColumn("_n", F.row_number().over(Window.partitionBy("id", "scope").orderBy("part", "rank"))).filter((F.col("part") == 0) | (F.col("_n") <= most))
    pos = F.row_number().over(Window.partitionBy("id").orderBy("scope", "part", "rank"))
    return best.select("id", pos.alias("pos"), "scope", F.col("doc_id").alias("table_key"), "score", "part")
