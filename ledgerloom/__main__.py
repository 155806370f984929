"""Jobs from a shell: build a catalog, rank tables, answer, repair, package. Run with spark-submit or python -m ledgerloom."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs
from .sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    jobs_of = p.add_subparsers(dest="job", required=True)
    build = jobs_of.add_parser("build", help="reports to a catalog")
    build.add_argument("--reports", required=True), build.add_argument("--out", required=True), build.add_argument("--companies"), build.add_argument("--force", action="store_true")
    for name, text in (("rank", "tables ranked for questions"), ("answer", "questions answered, as far as no model is needed"), ("repair", "answers diagnosed and repaired")):
        s = jobs_of.add_parser(name, help=text)
        s.add_argument("--questions", required=True, help="JSON lines with id and question"), s.add_argument("--catalog", required=True), s.add_argument("--companies", required=True), s.add_argument("--out", required=True), s.add_argument("--k", type=int, default=10)
    package = jobs_of.add_parser("package", help="answers as one JSON file with evidence")
    package.add_argument("--out", required=True), package.add_argument("--allow-partial", action="store_true")
    purge = jobs_of.add_parser("purge", help="stored results removed, so that they are computed anew")
    purge.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"ledgerloom {a.job}").getOrCreate()
    if a.job == "build":
        jobs.build_catalog(spark, a.reports, a.companies, a.out, a.force).show(truncate=False)
    elif a.job == "purge":
        print("\n".join(jobs.purge(spark, a.out)))
    elif a.job == "package":
        print(jobs.build_package(spark, a.out, a.allow_partial))
    else:
        q = files.read_jsonl(spark, a.questions, "id long, question string")
        t, c = spark.read.parquet(a.catalog), files.read_registry(spark, a.companies)
        if a.job == "rank":
            print(jobs.rank_questions(spark, q, t, c, f"{a.out}/rankings", a.k).count())
        elif a.job == "answer":
            jobs.answer_all(spark, q, t, c, a.out, k=a.k).groupBy("route", "executed").count().show()
        else:
            done = jobs.answer_all(spark, q, t, c, a.out, k=a.k)
            jobs.repair_all(spark, done, jobs.rank_questions(spark, q, t, c, f"{a.out}/rankings", a.k), t, c, f"{a.out}/repair").groupBy("action", "outcome").count().show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
