"""Whole jobs over files: catalog, rankings, answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import diagnose, extract, ground, link, normalize, package, plan, retrieve, scope
from ..session import settle
from ..sources import files


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def build_catalog(spark: SparkSession, reports: str, companies: str | None, out: str, force: bool = False) -> DataFrame:
    """Catalog, anomalies and summary under out; the stored summary is returned if all three are there."""
    parts = [f"{out}/{p}" for p in ("catalog", "anomalies", "summary")]
    if force or not all(exists(spark, f"{p}/_SUCCESS") for p in parts):
        names = files.read_registry(spark, companies) if companies else None
        tables = settle(normalize.normalize(extract.candidates(extract.read_reports(spark, reports)), names))
        files.write_catalog(tables, parts[0])
        extract.shape_flags(tables, "table_key", "report_id", "line_position", "source_path").write.mode("overwrite").parquet(parts[1])
        normalize.catalog_summary(tables).write.mode("overwrite").parquet(parts[2])
    return spark.read.parquet(parts[2])


def rank_questions(spark: SparkSession, questions: DataFrame, tables: DataFrame, companies: DataFrame, out: str, k: int = 10) -> DataFrame:
    """Rankings under out/<fingerprint of the questions and tables>; computed once per content and parameters."""
    mark = files.fingerprint(questions, ["id", "question"]) + files.fingerprint(tables, ["table_key", "ticker", "year", "variant", "section_header", "table_identity", "searchable_text", "row_labels"]) + files.fingerprint(companies, ["ticker", "name"]) + str(k)
    path = f"{out}/{abs(hash_text(mark)):x}"
    if not exists(spark, f"{path}/_SUCCESS"):
        retrieve.ranked_tables(questions, tables, companies, k).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def hash_text(s: str) -> int:
    import zlib

    return zlib.crc32(s.encode()) << 32 | zlib.adler32(s.encode())


def answer_lookups(questions: DataFrame, tables: DataFrame, rankings: DataFrame) -> DataFrame:
    """(id, family, table_key, row_index, column_index, answer, unit) of questions that one cell answers.

    answer is the cell brought from its column's unit to the unit asked for; null where the unit is asked
    for but the cell's isn't known. Questions of other shapes and those without a cell give no row.
    """
    q = questions.select("id", "question").dropDuplicates(["id"])
    ops = link.operands(q, rankings.select("id", "table_key"), link.value_cells(tables.join(rankings.select("table_key").distinct(), "table_key", "left_semi")))
    got = plan.direct_lookup(ops, q.filter(link.family(F.col("question")) == "direct_lookup"))
    unit = F.explode_outer("column_metadata")
    meta = tables.select("table_key", "detected_units", unit.alias("m")).select("table_key", "detected_units", F.col("m.column_index").alias("column_index"), F.col("m.source_unit").alias("source_unit"))
    got = got.join(meta, ["table_key", "column_index"], "left").join(q, "id")
    source = F.coalesce("source_unit", F.when(F.size("detected_units") == 1, F.get("detected_units", F.lit(0))))
    asked = link.requested_unit(F.col("question"))
    return got.select("id", F.lit("direct_lookup").alias("family"), "table_key", "row_index", "column_index", (F.col("numeric_value") * plan.scale_factor(source, asked)).alias("answer"), asked.alias("unit"))


def missing_companies(questions: DataFrame, companies: DataFrame, used: DataFrame) -> DataFrame:
    """(id, ticker) a question names of which no used cell (id, ticker) is."""
    named = scope.resolved_tickers(questions, companies).select("id", F.explode("tickers").alias("ticker"))
    return named.join(used.select("id", "ticker").distinct(), ["id", "ticker"], "left_anti")


def linked_operands(questions: DataFrame, rankings: DataFrame, tables: DataFrame) -> DataFrame:
    """Ordered operands with source_scale of the tables ranked for each question; only those tables are taken apart."""
    wanted = tables.join(rankings.select("table_key").distinct(), "table_key", "left_semi")
    ops = link.operands(questions, rankings.select("id", "table_key"), link.value_cells(wanted))
    # What nothing reads afterwards isn't shuffled or written.
    return ground.with_scales(settle(link.ordered(ops, scope.concepts(questions)).drop("raw_value", "asked_years", "asked_variant")), wanted)


def predictions(questions: DataFrame, rankings: DataFrame, tables: DataFrame, companies: DataFrame, complete: Callable[[str], str] | None = None, ignore_unit: bool = False, retries: int = 2) -> DataFrame:
    """One row per question from ranked tables to answer; what went wrong is data.

    id, question, family, route, answer, answer_unit, expression, cells (table_key, row_index, column_index of each cell the
    answer uses), used_tables, relevant_tables (at most RELEVANT_TABLES, in operand order), relevant_docs, n_retrieved,
    n_linked, attempts, executed, stage (generation where no plan came about, execution where it has no finite value, else
    null), reason. rankings: id, table_key. tables: one row per table_key; a ranked key without a table is the reason
    "table not in the store". complete is a text model for the questions of several cells; without one they have no answer.
    """
    q = questions.select("id", "question").dropDuplicates(["id"])
    pairs = rankings.select("id", "table_key").distinct()
    ops = settle(linked_operands(q, pairs, tables))
    r = settle(ground.routed(q, pairs, tables, companies, ops, ignore_unit))
    cell = F.when(F.col("table_key").isNotNull(), F.array(F.struct("table_key", "row_index", "column_index"))).otherwise(F.array().cast("array<struct<table_key:string,row_index:int,column_index:int>>"))
    r = r.withColumn("cells", cell).withColumn("attempts", F.when(F.col("route") == "model", 0).otherwise(1)).drop("table_key", "row_index", "column_index")
    if complete is not None:
        m = ground.modelled(r.filter("route = 'model'").select("id", "question", "family", "tickers"), ops, complete, retries)
        m = m.select("id", *[F.col(c).alias(f"m_{c}") for c in ("answer", "expression", "cells", "attempts", "reason")])
        of = lambda c: F.when(F.col("route") == "model", F.col(f"m_{c}")).otherwise(F.col(c))
        r = r.join(m, "id", "left").withColumns({c: of(c) for c in ("answer", "expression", "cells", "attempts", "reason")}).drop(*[f"m_{c}" for c in ("answer", "expression", "cells", "attempts", "reason")])
    lost = pairs.join(tables.select("table_key"), "table_key", "left_anti").select("id").distinct().withColumn("_lost", F.lit(True))
    n = pairs.groupBy("id").agg(F.count("*").alias("n_retrieved")).join(ops.groupBy("id").agg(F.count("*").alias("n_linked")), "id", "left")
    top = link.relevant_tables(ops).groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "table_key"))), lambda s: s["table_key"]).alias("relevant_tables"))
    j = r.join(lost, "id", "left").join(n, "id", "left").join(top, "id", "left")
    finite = F.coalesce(~F.isnan("answer") & (F.abs("answer") < float("inf")), F.lit(False))
    reason = F.when(F.col("_lost"), "table not in the store").when(F.col("reason").isNull() & ~finite, "not a finite number").otherwise(F.col("reason"))
    none = F.array().cast("array<string>")
    j = j.withColumn("reason", reason).withColumn("relevant_tables", F.coalesce("relevant_tables", none))
    executed = F.col("reason").isNull()
    return j.select(
        "id", "question", "family", "route", F.when(executed, F.col("answer")).alias("answer"), F.col("unit").alias("answer_unit"), "expression", "cells",
        F.array_distinct(F.transform("cells", lambda c: c["table_key"])).alias("used_tables"), "relevant_tables", F.array_distinct(F.transform("relevant_tables", lambda k: package.split_key(k)[0])).alias("relevant_docs"),
        F.coalesce("n_retrieved", F.lit(0)).alias("n_retrieved"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "attempts", executed.alias("executed"),
        F.when(~executed & F.col("expression").isNotNull(), "execution").when(~executed, "generation").alias("stage"), "reason",
    )


def answer_all(spark: SparkSession, questions: DataFrame, tables: DataFrame, companies: DataFrame, out: str, complete: Callable[[str], str] | None = None, k: int = 10, retries: int = 2) -> DataFrame:
    """Run from questions to answers under out: rankings, predictions, evidence. What has an answer already isn't asked again.

    predictions is appended to, so a run that was cut short goes on where it stopped; evidence has the cells of the tables
    that answers use, in long form. Ids must be unique. Returns all predictions, the latest of each question.
    """
    if questions.groupBy("id").count().filter("count > 1").limit(1).count():
        raise ValueError("an id stands twice")
    path, seen = f"{out}/predictions", None
    if exists(spark, f"{path}/_SUCCESS"):
        seen = settle(spark.read.parquet(path).filter("executed").select("id").distinct())
    pending = settle(questions if seen is None else questions.join(seen, "id", "left_anti"))
    if not pending.isEmpty():
        rankings = rank_questions(spark, questions, tables, companies, f"{out}/rankings", k)
        mine = rankings.join(pending.select("id"), "id", "left_semi")
        done = settle(predictions(pending, mine, tables, companies, complete, retries=retries).withColumn("run_at", F.current_timestamp()))
        done.write.mode("append").parquet(path)
        used = done.filter("executed").select("id", F.explode("used_tables").alias("table_key"))
        package.evidence(package.table_cells(tables), used).write.mode("append").parquet(f"{out}/evidence")
    latest = spark.read.parquet(path).groupBy("id").agg(F.max_by(F.struct("*"), F.struct("executed", "run_at")).alias("p"))
    return latest.select("p.*")


def repaired(diagnosis: DataFrame, rankings: DataFrame, tables: DataFrame, companies: DataFrame, complete: Callable[[str], str] | None = None) -> DataFrame:
    """Candidates (as `predictions` has rows, plus action) for the diagnosed questions, each action worked on as one set.

    rebuild_deterministic answers again without a model, resolve_unit_deterministic keeps the unit of the column where no
    other way is left, regenerate and relink_then_regenerate link again and ask the model; without one they give no row.
    keep and mark_unsupported give no row either.
    """
    d = settle(diagnosis.select("id", "question", "action"))
    parts = []
    for actions, model, ignore in ((("rebuild_deterministic",), None, False), (("resolve_unit_deterministic",), None, True), (("regenerate", "relink_then_regenerate"), complete, False)):
        mine = d.filter(F.col("action").isin(*actions))
        if (actions[0] == "regenerate" and complete is None) or mine.isEmpty():
            continue
        got = predictions(mine.select("id", "question"), rankings.join(mine.select("id"), "id", "left_semi"), tables, companies, model, ignore)
        parts.append(got.join(mine.select("id", "action"), "id"))
    if not parts:
        return predictions(d.limit(0).select("id", "question"), rankings.limit(0), tables.limit(0), companies).withColumn("action", F.lit(None).cast("string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def repair_all(spark: SparkSession, done: DataFrame, rankings: DataFrame, tables: DataFrame, companies: DataFrame, out: str, complete: Callable[[str], str] | None = None) -> DataFrame:
    """Repair failures and answers with signs; outcomes are appended under out/outcomes, accepted answers under out/accepted.

    done: predictions. A question whose outcome was accepted, rejected or unsupported before isn't tried again; one that
    waits for a model (pending) is. Returns all outcomes: id, action, outcome, why, signs_before, signs_after.
    """
    path = f"{out}/outcomes"
    p = done.dropDuplicates(["id"])
    if exists(spark, f"{path}/_SUCCESS"):
        p = p.join(spark.read.parquet(path).filter("outcome <> 'pending'").select("id").distinct(), "id", "left_anti")
    p = settle(p)
    good = settle(diagnose.diagnosed(diagnose.used_facts(p.filter("executed"))))
    bad = diagnose.diagnosed_failures(p.filter("not executed"))
    todo = settle(good.select("id", "question", "action", "codes").unionByName(bad.select("id", "question", "action", "codes")).filter("action <> 'keep'"))
    got = settle(diagnose.signs(diagnose.used_facts(repaired(todo, rankings, tables, companies, complete))))
    judged = settle(diagnose.outcomes(got, good.select("id", "codes", "expression", "cells")))
    tried = judged.select("id", F.when(F.col("accepted"), "accepted").otherwise("rejected").alias("outcome"), "why", "signs_before", "signs_after")
    j = todo.select("id", "action").join(tried, "id", "left")
    j = j.withColumn("outcome", F.coalesce("outcome", F.when(F.col("action") == "mark_unsupported", "unsupported").otherwise("pending")))
    j.write.mode("append").parquet(path)
    kept = judged.filter("accepted").withColumn("run_at", F.current_timestamp()).select(*done.columns)
    kept.write.mode("append").parquet(f"{out}/accepted")
    return spark.read.parquet(path)


def finalized(spark: SparkSession, done: DataFrame, out: str) -> DataFrame:
    """done with the accepted answers of `repair_all` in place of the originals."""
    accepted = spark.read.parquet(f"{out}/accepted") if exists(spark, f"{out}/accepted/_SUCCESS") else done.limit(0)
    return package.merged(accepted.select(*done.columns).dropDuplicates(["id"]), done).drop("origin")


def purge(spark: SparkSession, out: str) -> list[str]:
    """Stored results under out removed (catalog, anomalies, summary, rankings, predictions, evidence, repair); the paths that were there."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    gone = []
    for name in ("catalog", "anomalies", "summary", "rankings", "predictions", "evidence", "repair"):
        p = fs_path(f"{out}/{name}")
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True):
            gone.append(f"{out}/{name}")
    return gone


def package_records(done: DataFrame) -> DataFrame:
    """Executed predictions of lookups and extrema as records: id, question, relevant_docs, relevant_tables, evidence (variable, path), query, answer."""
    e = done.filter("executed and route <> 'model'")
    evidence = F.transform("used_tables", lambda k, i: F.struct(F.concat(F.lit("t"), (i + 1).cast("string")).alias("variable"), F.concat(F.lit("data/"), F.regexp_replace(k, r"[^A-Za-z0-9_.-]", "_"), F.lit(".csv")).alias("path")))
    constant = F.col("expression").rlike(r"^[0-9.]+$")
    query = F.when(constant, F.concat("expression", F.lit(" + 0 * "), package.rendered(F.lit("x"), F.col("cells"), F.col("used_tables")))).otherwise(package.rendered(F.col("expression"), F.col("cells"), F.col("used_tables")))
    return e.select("id", "question", "relevant_docs", "relevant_tables", evidence.alias("evidence"), query.alias("query"), "answer")


def build_package(spark: SparkSession, out: str, allow_partial: bool = False) -> int:
    """The answers under out as out/package.json; refuses with the errors found, as far as they aren't allowed. Returns the records."""
    done = spark.read.parquet(f"{out}/predictions").groupBy("id").agg(F.max_by(F.struct("*"), F.struct("executed", "run_at")).alias("p")).select("p.*")
    records = settle(package_records(done))
    wrong = package.refusals(done, done, allow_partial).unionByName(package.check_records(records)).limit(20).collect()
    if wrong:
        raise ValueError("; ".join(f"{r.id}: {r.error}" for r in wrong))
    return files.write_single_json(records, f"{out}/package.json", ["id"])
