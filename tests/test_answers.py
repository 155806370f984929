"""Whole retrieval, plans from a text model, jobs over files, shared joins."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators import complete, diagnose, retrieve
from ledgerloom.operators.complete import PlanError
from ledgerloom.plans import jobs

LABELS = "array<struct<row_index:int,column_index:int,label:string>>"


def tables(spark):
    def row(key, ticker, year, variant, text, labels, section="notes"):
        return (key, ticker, year, variant, text, [(i, 0, x) for i, x in enumerate(labels)], section, None)

    rows = [
        row("A|1", "AAA", 2020, "separate", "vốn chủ sở hữu cuối kỳ", ["Vốn chủ sở hữu"], "balance_sheet"),
        row("A|2", "AAA", 2020, "consolidated", "lợi nhuận sau thuế", ["Lợi nhuận sau thuế"], "income_statement"),
        row("A|3", "AAA", 2019, "separate", "vốn chủ sở hữu cuối kỳ", ["Vốn chủ sở hữu"], "balance_sheet"),
        row("B|1", "BBB", 2020, "separate", "vốn chủ sở hữu vốn chủ sở hữu", ["Vốn chủ sở hữu"], "balance_sheet"),
        row("N|1", None, None, None, "", []),
    ]
    return spark.createDataFrame(rows, f"table_key string, ticker string, year int, variant string, searchable_text string, row_labels {LABELS}, section_header string, table_identity string")


def companies(spark):
    return spark.createDataFrame([("AAA", "Công ty Alphax"), ("BBB", "Công ty Betaxy"), ("CCC", "Công ty Gammaz")], "ticker string, name string")


def test_ranked_tables(spark):
    q = spark.createDataFrame([(1, "Vốn chủ sở hữu của AAA năm 2020"), (2, "ROE của AAA"), (3, "vốn chủ sở hữu"), (4, "AAA và BBB vốn chủ sở hữu 2020"), (5, "CCC vốn chủ sở hữu"), (6, None), (1, "Vốn chủ sở hữu của AAA năm 2020")], "id int, question string")
    got = retrieve.ranked_tables(q, tables(spark), companies(spark), k=3).collect()
    by = {i: [r.table_key for r in sorted(got, key=lambda r: r.pos) if r.id == i] for i in range(1, 7)}
    assert by[1][0] == "A|1" and "A|3" not in by[1] and "B|1" not in by[1]  # the year scopes, no other issuer
    assert set(by[2]) == {"A|1", "A|2", "A|3"}  # both operands of the ratio
    assert "B|1" in by[3] and "A|1" in by[3]  # everywhere
    assert by[4][-1] == "B|1" and by[4][0].startswith("A|") and by[5] == [] and by[6] == []
    assert retrieve.ranked_tables(q.limit(0), tables(spark), companies(spark)).count() == 0
    named = spark.createDataFrame([(3, "BBB"), (3, "NONE"), (5, "NONE")], "id int, ticker string")
    got = retrieve.ranked_tables(q, tables(spark), companies(spark), k=3, named=named).collect()
    assert {r.table_key for r in got if r.id == 3} == {"B|1"} and {r.scope for r in got if r.id in (1, 5)} == {"*"}


def test_another_issuers_tables_change_nothing(spark):
    q = spark.createDataFrame([(1, "Vốn chủ sở hữu của AAA")], "id int, question string")
    t = tables(spark)
    key = lambda d: sorted((r.table_key, round(r.score, 9)) for r in retrieve.ranked_tables(q, d, companies(spark)).collect())
    more = t.filter("ticker = 'BBB'").withColumn("table_key", F.concat("table_key", F.lit("x")))
    assert key(t) == key(t.unionByName(more).repartition(5))


CELLS = {("t", 1, 1): ("Doanh thu", "2020", 100.0), ("t", 1, 2): ("Doanh thu", "2019", 80.0), ("t", 2, 1): ("Lỗ", "2020", 0.0)}


def op(alias, r, c, t="t"):
    return {"alias": alias, "table_key": t, "row_index": r, "column_index": c}


def test_plans():
    p = {"operands": [op("a", 1, 1), op("b", 1, 2)], "expression": "(a - b) / abs(b) * 100"}
    assert complete.evaluate(p, CELLS, several=True) == 25.0
    g = {"groups": [{"name": "g", "operands": [op("a", 1, 1), op("b", 1, 2)]}], "reductions": [{"alias": "n", "op": "count_gt", "group": "g", "threshold": 90}, {"alias": "m", "op": "avg", "group": "g"}], "expression": "n + m + a"}
    assert complete.evaluate(g, CELLS) == 191.0


@pytest.mark.parametrize(
    "plan,why",
    [
        ({}, "empty"), ({"operands": [op("a", 9, 9)], "expression": "a"}, "outside"), ({"operands": [op("a", 1, 1), op("a", 1, 2)], "expression": "a"}, "twice"), ({"operands": [op("1a", 1, 1)], "expression": "1"}, "identifier"),
        ({"operands": [op("a", 2, 1)], "expression": "1 / a"}, "computed"), ({"operands": [op("a", 1, 1)], "expression": "a ** 9999"}, "computed"), ({"operands": [op("a", 1, 1)], "expression": "open(a)"}, "allowed"), ({"operands": [{"alias": "a"}], "expression": "a"}, "lacks"),
        ({"operands": [op("a", 1, 1)], "reductions": [{"alias": "m", "op": "median", "group": "g"}], "expression": "m"}, "unknown reduction"), ({"groups": [{"name": "g", "operands": []}], "expression": "1"}, "empty"), ({"operands": [op("a", 1, 1)], "expression": "(0 - a) ** 0.5"}, "finite"),
    ],
)
def test_refused_plans(plan, why):
    with pytest.raises(PlanError, match=why):
        complete.evaluate(plan, CELLS)


def test_answer_retries_with_the_reason():
    seen, replies = [], iter(["no plan", "{]}", "Here: " + json.dumps({"operands": [op("a", 1, 1)], "expression": "a"}) + " done"])

    def model(text):
        seen.append(text)
        return next(replies)

    got = complete.answer("q", CELLS, model)
    assert got.value == 100.0 and len(got.errors) == 2 and "no JSON object" in seen[1] and "not JSON" in seen[2]

    def starved(_):
        raise MemoryError("full")

    assert complete.answer("q", CELLS, starved).errors == ["out of memory: full"]
    assert complete.answer("q", CELLS, lambda _: "{}", retries=1).value is None


def test_budget(spark):
    ops = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 5), (2, 1, 50)], "id int, pos int, size int")
    assert sorted((r.id, r.pos) for r in complete.within_budget(ops, "size", 10).collect()) == [(1, 1), (1, 2)]


def test_jobs(spark, tmp_path):
    d = tmp_path / "in" / "AAA_2020_separate"
    d.mkdir(parents=True)
    (d / "AAA_2020_separate_extracted.txt").write_text("BẢNG CÂN ĐỐI KẾ TOÁN\nĐơn vị tính: triệu đồng\n<table><tr><td>Chỉ tiêu</td><td>Năm 2020</td></tr><tr><td>Vốn chủ sở hữu</td><td>1.500</td></tr></table>\n", encoding="utf-8")
    out = str(tmp_path / "out")
    s = jobs.build_catalog(spark, str(tmp_path / "in"), None, out).first()
    assert (s.n_tables, s.n_reports, s.n_failed) == (1, 1, 0)
    (d / "AAA_2020_separate_extracted.txt").write_text("", encoding="utf-8")
    assert jobs.build_catalog(spark, str(tmp_path / "in"), None, out).first().n_tables == 1  # kept
    t = spark.read.parquet(f"{out}/catalog")
    q = spark.createDataFrame([(7, "Vốn chủ sở hữu của AAA năm 2020 là bao nhiêu tỷ đồng?")], "id int, question string")
    r = jobs.rank_questions(spark, q, t, companies(spark), str(tmp_path / "r"))
    assert [x.table_key for x in r.collect()] == ["AAA_2020_separate|3"]
    assert jobs.rank_questions(spark, q, t, companies(spark), str(tmp_path / "r")).count() == 1 and len(list((tmp_path / "r").iterdir())) == 1
    a = jobs.answer_lookups(q, t, r).first()
    assert (a.answer, a.unit, a.row_index, a.column_index) == (1.5, "tỷ đồng", 1, 1)
    used = spark.createDataFrame([(7, "BBB")], "id int, ticker string")
    assert [tuple(x) for x in jobs.missing_companies(q, companies(spark), used).collect()] == [(7, "AAA")]


def test_signs_and_acceptance(spark):
    p = spark.createDataFrame(
        [(1, "So với 2019, BBB năm 2020 chênh lệch bao nhiêu", 1e16, ["AAA"], [2018], ["separate"], 1, 1), (2, "Doanh thu hợp nhất AAA 2020", 5.0, ["AAA"], [2020], ["consolidated"], 1, 1), (3, "x", None, [], [], [], 0, 0), (4, None, float("nan"), None, None, None, None, None)],
        "id int, question string, answer double, used_tickers array<string>, used_years array<int>, used_variants array<string>, n_tables int, n_cells int",
    )
    got = {r.id: r.codes for r in diagnose.signs(p).collect()}
    assert got == {1: ["collapse", "entity", "year", "structure", "magnitude"], 2: [], 3: [], 4: ["magnitude"]}
    cells = "cells array<struct<table_key:string,row_index:int,column_index:int>>"
    one = [("t", 1, 1)]
    o = spark.createDataFrame([(1, ["collapse", "entity"], "x", one), (2, ["year"], "x", one), (5, ["year"], "x", one)], f"id int, codes array<string>, expression string, {cells}")
    c = spark.createDataFrame(
        [(1, 2.0, "a - b", one, True, ["year"]), (2, 5.0, "x", one, True, []), (3, 1.0, "x", one, True, []), (9, 1.0, "x", one, True, ["year"]), (4, None, None, [], False, []), (5, 1.0, "y", one, True, ["year"]), (6, float("nan"), "x", one, True, [])],
        f"id int, answer double, expression string, {cells}, executed boolean, codes array<string>",
    )
    got = {r.id: (r.accepted, r.why) for r in diagnose.outcomes(c, o).collect()}
    assert got == {1: (True, "fewer signs"), 2: (False, "the same plan"), 3: (True, "recovered"), 9: (False, "recovered with signs"), 4: (False, "not executed"), 5: (False, "no fewer signs"), 6: (False, "not a finite number")}
    assert tuple(diagnose.final_report(o, c.filter("id in (1, 3)")).first()) == (4, 2, 1, 1)


def test_actions(spark):
    base = [(1, "So với 2019, BBB năm 2020 chênh lệch bao nhiêu", 1e16, ["AAA"], [2018], [], 1, 1, "x"), (2, "Doanh thu AAA 2020", 5.0, ["AAA"], [2020], [], 1, 1, "x"), (3, "Doanh thu AAA 2020", 5.0, ["AAA"], [2019], [], 1, 1, "x"), (4, "Công ty nào có doanh thu cao nhất", 1.0, [], [], [], 1, 1, "x"), (5, "AAA năm nào cao nhất, 2019 hay 2020", 2020.0, ["AAA"], [2018], [], 1, 1, "2020.0"), (6, "Tỷ lệ nợ", 1.0, [], [], [], 1, 1, "x")]
    p = spark.createDataFrame(base, "id int, question string, answer double, used_tickers array<string>, used_years array<int>, used_variants array<string>, n_tables int, n_cells int, expression string")
    got = {r.id: (r.action, r.budget) for r in diagnose.diagnosed(p).collect()}
    assert got == {1: ("relink_then_regenerate", 2), 2: ("keep", 0), 3: ("rebuild_deterministic", 1), 4: ("mark_unsupported", 0), 5: ("keep", 0), 6: ("regenerate", 2)}
    f = spark.createDataFrame([(1, "x", "no unambiguous source unit"), (2, "x", "no operand of the asked year"), (3, "x", "not JSON: y"), (4, "Ngân hàng nào lớn nhất", None), (5, "x", None)], "id int, question string, reason string")
    assert {r.id: r.action for r in diagnose.diagnosed_failures(f).collect()} == {1: "resolve_unit_deterministic", 2: "relink_then_regenerate", 3: "regenerate", 4: "mark_unsupported", 5: "regenerate"}
    ids = spark.createDataFrame([("AAA_financial_statements_2020_separate",), ("AAA_financial_statements_2020",), ("AAA_2020",)], "r string")
    assert [tuple(r) for r in ids.select(*[c.alias(k) for k, c in diagnose.strict_parts(F.col("r")).items()]).collect()] == [("AAA", 2020, "separate"), ("AAA", 2020, None), (None, None, None)]


@pytest.mark.parametrize("hot", [5, 10**6])
def test_groups_of_any_size(spark, hot):
    members = spark.range(300).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) as k", "id")
    groups = session.settle(members.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1"))
    got = session.attach_groups(members, groups, ["k"], "n", hot)
    want = members.join(groups, "k")
    assert sorted((r.k, r.id, r.n) for r in got.collect()) == sorted((r.k, r.id, r.n) for r in want.collect())


@pytest.mark.parametrize("limit", [1, 8 << 20])
def test_checked_join_is_the_same_either_way(spark, limit):
    a, b = spark.range(50), spark.range(0, 100, 3)
    j = session.join_checked(a, b, "id", "left_semi", 8, limit)
    assert sorted(r.id for r in j.collect()) == list(range(0, 50, 3))
    assert ("BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()) or limit == 1


def test_wide_rows_are_measured(spark):
    """Few rows of long texts are too much to broadcast though their count is small."""
    a, b = spark.range(50), spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "id bigint, t string")
    plan = lambda limit: session.join_checked(a, b, "id", "inner", 8, limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(100_000) and "broadcast" not in plan(10_000)


def test_settle_cuts_the_plan(spark):
    d = session.settle(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Scan ExistingRDD" in d._jdf.queryExecution().executedPlan().toString() and d.count() == 5
