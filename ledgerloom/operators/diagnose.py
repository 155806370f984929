"""Signs that an answer is wrong, as predicate columns over predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ground import REASONS
from .link import family
from .scope import literal_codes, variant, years

# Fixed values.
SEVERAL = ("ratio_or_derived", "growth", "aggregation", "comparison", "cross_company_comparison")
STRUCTURED = ("comparison", "growth", "ratio_or_derived")
LARGEST, SMALLEST = 1e15, 1e-9
REPORT = r"^([A-Z0-9]+)_financial_statements_([0-9]{4})(?:_(consolidated|separate))?$"
WHICH_COMPANY, SUPERLATIVES = ("công ty nào", "doanh nghiệp nào", "ngân hàng nào"), ("cao nhất", "lớn nhất", "thấp nhất", "nhỏ nhất")


def strict_parts(report_id: Column) -> dict[str, Column]:
    """ticker, year and variant of a report id of exactly the expected shape; all null for any other."""
    fits = report_id.rlike(REPORT)
    part = lambda k: F.when(fits, F.regexp_extract(report_id, REPORT, k))
    return {"ticker": part(1), "year": part(2).try_cast("int"), "variant": F.when(part(3) != "", part(3))}


def used_facts(predictions: DataFrame) -> DataFrame:
    """predictions (used_tables, cells) plus used_tickers, used_years, used_variants by report id, n_tables and n_cells."""
    report = lambda k: F.regexp_extract(k, r"^(.*)\|[^|]*$", 1)
    fact = lambda name: F.array_sort(F.array_distinct(F.array_compact(F.transform("used_tables", lambda k: strict_parts(report(k))[name]))))
    return predictions.withColumns({f"used_{n}s": fact(n) for n in ("ticker", "year", "variant")}).withColumn("n_tables", F.size("used_tables")).withColumn("n_cells", F.size(F.array_distinct("cells")))


def unsupported(question: Column) -> Column:
    """Whether a question asks which company is largest or smallest; a plan can only give a number."""
    q = F.lower(F.coalesce(question, F.lit("")))
    said = lambda words: F.greatest(*[q.contains(w) for w in words])
    return said(SUPERLATIVES) & said(WHICH_COMPANY)


def signs(p: DataFrame) -> DataFrame:
    """p plus codes: the signs that hold, in order.

    p: id, question, answer, used_tickers, used_years, used_variants (arrays), n_tables, n_cells.
    collapse: a question for several values uses one table at most; entity, year, variant: what the
    question names isn't among what was used (a year may also stand in the expression, where the predictions have one); structure: a comparison of one cell; magnitude: a value
    that isn't finite or is beyond plausible bounds.
    """
    q, a = F.col("question"), F.col("answer")
    written = F.lower(F.coalesce("expression", F.lit(""))) if "expression" in p.columns else F.lit("")
    kind = family(q)
    named, asked, want = literal_codes(q), years(q), variant(q)
    missing = lambda asked_for, used: (F.size(asked_for) > 0) & (F.size(used) > 0) & ~F.arrays_overlap(asked_for, used)
    tests = {
        "collapse": kind.isin(*SEVERAL) & (F.col("n_tables") <= 1),
        "entity": missing(named, F.col("used_tickers")),
        "year": missing(asked, F.col("used_years")) & ~F.exists(asked, lambda y: written.contains(y.cast("string"))),
        "variant": want.isNotNull() & (F.size("used_variants") > 0) & ~F.array_contains("used_variants", want),
        "structure": kind.isin(*STRUCTURED) & (F.col("n_cells") <= 1),
        "magnitude": F.isnan(a) | (F.abs(a) > LARGEST) | ((a != 0) & (F.abs(a) < SMALLEST)),
    }
    return p.withColumn("codes", F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), n) for n, t in tests.items()])))


def summary(diagnosed: DataFrame) -> DataFrame:
    """Predictions per combination of signs."""
    return diagnosed.groupBy(F.array_join(F.array_sort("codes"), "+").alias("combination")).agg(F.count("*").alias("n"))


def diagnosed(p: DataFrame) -> DataFrame:
    """signs plus action and budget: keep, mark_unsupported, rebuild_deterministic, relink_then_regenerate or regenerate."""
    d = signs(p)
    about = F.arrays_overlap("codes", F.array(*map(F.lit, ("entity", "year", "variant"))))
    action = (
        F.when(unsupported(F.col("question")), "mark_unsupported").when(F.size("codes") == 0, "keep").when(family(F.col("question")) == "direct_lookup", "rebuild_deterministic")
        .when(about, "relink_then_regenerate").otherwise("regenerate")
    )
    d = d.withColumn("action", action).withColumn("codes", F.when(F.col("action") == "mark_unsupported", F.array(F.lit("unsupported"))).otherwise(F.col("codes")))
    return d.withColumn("budget", F.when(F.col("action").isin("keep", "mark_unsupported"), 0).when(F.col("action") == "rebuild_deterministic", 1).otherwise(2))


def diagnosed_failures(f: DataFrame) -> DataFrame:
    """f (id, question, reason) plus codes, action and budget, by the reason for which there was no answer."""
    r = F.coalesce("reason", F.lit(""))
    pool = r.isin(*REASONS[:4]) | r.contains("required companies") | r.contains("is incomplete") | r.contains("an empty plan")
    action = F.when(unsupported(F.col("question")), "mark_unsupported").when(r.contains(REASONS[4]), "resolve_unit_deterministic").when(pool, "relink_then_regenerate").otherwise("regenerate")
    f = f.withColumn("action", action).withColumn("codes", F.array(F.when(F.col("action") == "mark_unsupported", "unsupported").otherwise("failure")))
    return f.withColumn("budget", F.when(F.col("action") == "mark_unsupported", 0).when(F.col("action") == "resolve_unit_deterministic", 1).otherwise(2))


def outcomes(candidates: DataFrame, originals: DataFrame) -> DataFrame:
    """candidates plus accepted, why, signs_before and signs_after.

    candidates: id, answer, expression, cells, executed, codes. originals: the same of answers that stood before; a candidate
    without one recovers a failure and must be free of signs, one with an original must differ from it (expression or cells)
    and have fewer signs.
    """
    o = originals.select("id", F.lit(True).alias("_was"), F.size("codes").alias("signs_before"), F.struct("expression", "cells").alias("_before"))
    j = candidates.join(o, "id", "left").withColumn("signs_after", F.size("codes"))
    finite = F.coalesce(F.col("answer").isNotNull() & ~F.isnan("answer") & (F.abs("answer") < float("inf")), F.lit(False))
    why = (
        F.when(~F.coalesce("executed", F.lit(False)), "not executed").when(~finite, "not a finite number").when(F.col("_was") & F.struct("expression", "cells").eqNullSafe(F.col("_before")), "the same plan")
        .when(F.col("_was").isNull() & (F.col("signs_after") > 0), "recovered with signs").when(F.col("_was").isNull(), "recovered")
        .when(F.col("signs_after") >= F.col("signs_before"), "no fewer signs").otherwise("fewer signs")
    )
    return j.withColumn("why", why).withColumn("accepted", F.col("why").isin("recovered", "fewer signs")).drop("_was", "_before")


def final_report(originals: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row: answers in all, unchanged, repaired (an original was overridden) and recovered (there was none)."""
    j = originals.select("id", F.lit(1).alias("o")).dropDuplicates(["id"]).join(accepted.select("id", F.lit(1).alias("a")).dropDuplicates(["id"]), "id", "full")
    return j.agg(F.count("*").alias("n_total"), F.count_if(F.col("a").isNull()).alias("n_unchanged"), F.count_if((F.col("a") == 1) & (F.col("o") == 1)).alias("n_repaired"), F.count_if(F.col("o").isNull()).alias("n_recovered"))


def magnitude_ok(a: Column) -> Column:
    return ~F.isnan(a) & (F.abs(a) <= LARGEST) & ((a == 0) | (F.abs(a) >= SMALLEST))
