"""Grounding, routes, whole answers, repair and evaluation on small cases of our own."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import complete, ground
from ledgerloom.operators.complete import Asked, Fact, PlanError
from ledgerloom.plans import jobs

LABELS = "array<struct<row_index:int,column_index:int,label:string>>"
META = "array<struct<column_index:int,header_path:string,period_labels:array<string>,source_unit:string,scale_to_vnd:bigint>>"
SCHEMA = f"table_key string, report_id string, ticker string, year int, variant string, table_identity string, section_header string, searchable_text string, row_labels {LABELS}, column_metadata {META}, detected_units array<string>, grid array<array<string>>"


def made(key, ticker, year, variant, grid, units=(), meta=None, identity="x"):
    labels = [(i, 0, r[0]) for i, r in enumerate(grid) if r and r[0]]
    return (key, key.split("|")[0], ticker, year, variant, identity, "balance_sheet", " ".join(c for r in grid for c in r), labels, meta, list(units), grid)


def tables(spark):
    rows = [
        made("A_2020|1", "AAA", 2020, "separate", [["Chỉ tiêu", "Số cuối năm (triệu đồng)", "Số đầu năm (triệu đồng)"], ["Vốn chủ sở hữu", "1.500", "1.200"], ["Doanh thu thuần", "90", "80"]]),
        made("A_2020c|1", "AAA", 2020, "consolidated", [["Chỉ tiêu", "Năm 2020"], ["Vốn chủ sở hữu", "9.000"]], ["tỷ đồng"]),
        made("A_2019|1", "AAA", 2019, "separate", [["Chỉ tiêu", "Năm 2019"], ["Vốn chủ sở hữu", "1.100"]], ["triệu đồng", "tỷ đồng"]),
        made("A_2021|1", "AAA", 2021, "separate", [["Chỉ tiêu", "Năm 2021"], ["Vốn chủ sở hữu", "1.700"]], ["triệu đồng"]),
        made("B_2020|1", "BBB", 2020, "separate", [["Chỉ tiêu", "Năm 2020"], ["Vốn chủ sở hữu", "5"]], ["tỷ đồng"]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def companies(spark):
    return spark.createDataFrame([("AAA", "Công ty Alphax"), ("BBB", "Công ty Betaxy AAA2"), ("CCC", "Công ty Gammaz BBB")], "ticker string, name string")


ASKED = [
    (1, "Vốn chủ sở hữu cuối năm của AAA năm 2020 công ty mẹ là bao nhiêu tỷ đồng?"), (2, "Vốn chủ sở hữu hợp nhất của AAA năm 2020 là bao nhiêu tỷ đồng?"), (3, "Vốn chủ sở hữu của AAA năm 2019 là bao nhiêu tỷ đồng?"),
    (4, "Vốn chủ sở hữu của AAA năm 2015 là bao nhiêu?"), (5, "Trong các năm 2019-2021 vốn chủ sở hữu của AAA công ty mẹ năm nào cao nhất?"), (6, "Trong các năm 2020 và 2021 vốn chủ sở hữu cuối của AAA công ty mẹ thấp nhất là bao nhiêu tỷ đồng?"),
    (7, "So với BBB, vốn chủ sở hữu của AAA năm 2020 chênh lệch bao nhiêu?"), (8, "Vốn chủ sở hữu đầu năm của AAA năm 2020 công ty mẹ là bao nhiêu tỷ đồng?"), (9, "x"), (10, None),
]


def everything(spark, questions=None):
    q = spark.createDataFrame(questions or ASKED, "id int, question string")
    return q, q.select("id").crossJoin(tables(spark).select("table_key"))


def test_predictions_without_a_model(spark):
    q, pairs = everything(spark)
    got = {r.id: r for r in jobs.predictions(q, pairs, tables(spark), companies(spark)).collect()}
    assert {i: (r.route, r.answer, r.reason) for i, r in got.items()} == {
        1: ("lookup", 1.5, None), 2: ("lookup", 9000.0, None), 3: ("lookup", None, ground.REASONS[4]), 4: ("lookup", None, ground.REASONS[2]), 5: ("extremum", 2021.0, None), 6: ("extremum", 1.5, None),
        7: ("model", None, "needs a model"), 8: ("lookup", 1.2, None), 9: ("lookup", got[9].answer, got[9].reason), 10: ("lookup", got[10].answer, got[10].reason),
    }
    assert got[1].cells[0].table_key == "A_2020|1" and (got[1].cells[0].row_index, got[1].cells[0].column_index) == (1, 1) and got[1].expression == "x * 0.001" and got[5].expression == "2021.0"
    assert got[1].relevant_docs == list(dict.fromkeys(k.rsplit("|", 1)[0] for k in got[1].relevant_tables)) and got[1].n_retrieved == 5 and got[4].stage == "generation" and got[1].stage is None
    assert jobs.predictions(q.limit(0), pairs, tables(spark), companies(spark)).count() == 0
    none = {r.id: r.reason for r in jobs.predictions(q, pairs.limit(0), tables(spark), companies(spark)).collect()}
    assert none[1] == ground.REASONS[0] and len(none) == 10


def test_unit_fallback_keeps_the_columns_unit(spark):
    q, pairs = everything(spark)
    got = {r.id: (r.answer, r.reason) for r in jobs.predictions(q, pairs, tables(spark), companies(spark), ignore_unit=True).collect()}
    assert got[3] == (1100.0, None) and got[1][0] == 1.5 and got[4][1] is None


def test_a_missing_table_is_a_reason(spark):
    q, pairs = everything(spark)
    lost = pairs.unionByName(spark.createDataFrame([(1, "gone|1")], "id int, table_key string"))
    got = {r.id: r for r in jobs.predictions(q, lost, tables(spark), companies(spark)).collect()}
    assert got[1].reason == "table not in the store" and got[1].answer is None and not got[1].executed and got[2].executed


def plan_of(prompt):
    """A model that subtracts the first cell of B from the first of A that stand in the prompt, wrong at first."""
    if "The last plan was refused" not in prompt:
        return "no plan"
    cells = json.loads(prompt.split("Cells: ")[1].split("\n")[0])
    a, b = (next(c for c in cells if c["table_key"].startswith(x)) for x in ("A_2020|", "B_"))
    op = lambda alias, c: {"alias": alias, **{k: c[k] for k in ("table_key", "row_index", "column_index")}}
    return json.dumps({"operands": [op("a", a), op("b", b)], "expression": "a - b"})


def test_a_model_answers_what_needs_several_cells(spark):
    q, pairs = everything(spark)
    got = {r.id: r for r in jobs.predictions(q, pairs, tables(spark), companies(spark), complete=plan_of).collect()}
    r = got[7]
    assert r.answer == 1500.0 - 5.0 and r.expression == "a - b" and r.attempts == 2 and sorted(r.used_tables) == ["A_2020|1", "B_2020|1"] and got[1].answer == 1.5
    bad = {r.id: r for r in jobs.predictions(q, pairs, tables(spark), companies(spark), complete=lambda _: "{}", retries=0).collect()}
    assert bad[7].answer is None and "empty plan" in bad[7].reason and bad[7].stage == "generation"


def test_a_run_goes_on_where_it_stopped(spark, tmp_path):
    q = spark.createDataFrame([(1, "Vốn chủ sở hữu của AAA năm 2021 là bao nhiêu tỷ đồng?"), (7, "So với BBB năm 2020, vốn chủ sở hữu của AAA năm 2020 chênh lệch bao nhiêu?")], "id int, question string")
    t, c, out = tables(spark), companies(spark), str(tmp_path / "run")
    first = {r.id: r.answer for r in jobs.answer_all(spark, q, t, c, out).collect()}
    assert first == {1: 1.7, 7: None}
    again = {r.id: r.answer for r in jobs.answer_all(spark, q, t, c, out, complete=plan_of).collect()}
    assert again == {1: 1.7, 7: 1495.0}
    runs = spark.read.parquet(f"{out}/predictions").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in runs} == {1: 1, 7: 2}  # the answered question wasn't asked again
    assert spark.read.parquet(f"{out}/evidence").filter("id = 7").select("table_key").distinct().count() == 2
    with pytest.raises(ValueError, match="twice"):
        jobs.answer_all(spark, q.unionByName(q), t, c, out)


def test_codes_inside_other_names(spark):
    av = spark.createDataFrame([(1, ["AAA", "BBB"]), (2, ["BBB", "CCC"]), (3, ["AAA"]), (4, None)], "id int, available array<string>")
    q = spark.createDataFrame([(1, "AAA so với BBB"), (2, "Lợi nhuận của BBB"), (3, "BBB và VND"), (4, "AAA"), (5, None)], "id int, question string")
    assert {r.id: r.tickers for r in ground.precise_tickers(q, av, companies(spark)).collect()} == {1: ["AAA", "BBB"], 2: ["CCC"], 3: [], 4: [], 5: []}


def test_groups_must_fit_the_question():
    cells = {("t", 1, 1): Fact("Doanh thu", "2020", 100.0, "AAA", 2020, "separate"), ("t", 2, 1): Fact("Doanh thu", "Năm 2019", 80.0, "BBB", 2018, "consolidated"), ("t", 3, 1): Fact("Lỗ", "2020", 1.0, "AAA", 2020, None)}
    op = lambda alias, r: {"alias": alias, "table_key": "t", "row_index": r, "column_index": 1}
    group = lambda *ops, metric="": {"groups": [{"name": "g", "metric_label": metric, "operands": list(ops)}], "reductions": [{"alias": "s", "op": "sum", "group": "g"}], "expression": "s"}
    ok = lambda plan, **asked: complete.evaluate(plan, cells, asked=Asked(**asked))
    assert ok(group(op("a", 1), op("b", 2))) == 180.0 and ok(group(op("a", 1), metric="doanh thu thuần"), years=frozenset({2020}), variant="separate", tickers=frozenset({"AAA"})) == 100.0
    for plan, asked, why in [
        (group(op("a", 1), op("b", 2)), {"years": frozenset({2020})}, "another period"), (group(op("a", 1), op("b", 2)), {"variant": "separate"}, "report variant"), (group(op("a", 1)), {"tickers": frozenset({"AAA", "BBB"})}, "no cell of BBB"),
        (group(op("a", 1), op("b", 3), metric="Doanh thu"), {}, "doesn't name"), ({"operands": [op("a", 1)], "expression": "a"}, {"tickers": frozenset({"BBB"})}, "required companies"), ({"operands": [op("a", 1)], "expression": "a"}, {"several": True}, "several cells"),
    ]:
        with pytest.raises(PlanError, match=why):
            ok(plan, **asked)


def test_units_in_four_steps(spark):
    rows = [
        ([["a", "Năm (tỷ đồng)"], ["x", "1"]], [(1, "", None, None, 5)], ["triệu đồng"]), ([["a", "Năm"], ["x", "1"]], [(1, "", None, None, 1000)], ["triệu đồng"]), ([["a", "Năm"], ["x", "1"]], None, ["triệu đồng", "Triệu  VND"]), ([["a", "Năm"], ["x", "1"]], [], ["triệu đồng", "tỷ đồng"]),
    ]
    df = spark.createDataFrame(rows, f"grid array<array<string>>, column_metadata {META}, detected_units array<string>")
    none = F.array().cast(df.schema["column_metadata"].dataType)
    got = [r.s[1] for r in df.select(ground.column_scales(F.col("grid"), F.coalesce("column_metadata", none), F.col("detected_units")).alias("s")).collect()]
    assert got == [10**9, 1000, 10**6, None]


def test_repair_from_failure_to_final(spark, tmp_path):
    """A unit nobody states is resolved, a question of several cells waits for a model and then is answered, the rest stays."""
    q, pairs = everything(spark, [a for a in ASKED if a[0] in (1, 3, 7)] + [(11, "Công ty nào có vốn chủ sở hữu lớn nhất?")])
    t, c, out = tables(spark), companies(spark), str(tmp_path)
    done = jobs.predictions(q, pairs, t, c)
    first = {r.id: (r.action, r.outcome) for r in jobs.repair_all(spark, done, pairs, t, c, out).collect()}
    assert first[3] == ("resolve_unit_deterministic", "accepted") and first[7] == ("regenerate", "pending") and 1 not in first and first[11][1] == "unsupported"
    both = {r.id: r.outcome for r in jobs.repair_all(spark, done, pairs, t, c, out, complete=plan_of).filter("outcome <> 'pending'").collect()}
    assert both == {3: "accepted", 7: "accepted", 11: "unsupported"}
    final = {r.id: r.answer for r in jobs.finalized(spark, done, out).collect()}
    assert final[1] == 1.5 and final[3] == 1100.0 and final[7] == 1495.0 and len(final) == 4


def test_evaluation_over_a_fixture(spark):
    from ledgerloom.operators import metrics

    ranked = spark.createDataFrame([(1, "a|1", 1), (1, "a|2", 2), (1, "b|1", 3), (2, "c|1", 1)], "query_id int, key string, rank int")
    want = spark.createDataFrame([(1, "b|1"), (1, "a|9"), (2, "d|1"), (3, "e|1")], "query_id int, key string")
    doc = F.regexp_extract("key", r"^(.*)\|", 1)
    got = {r.level: (round(r.recall_macro, 6), round(r.mrr, 6)) for r in metrics.sheet(ranked, want, doc).collect()}
    assert got == {"tables": (round(0.5 / 3, 6), round(1 / 9, 6)), "documents": (round(1 / 3, 6), round(1 / 3, 6))}
    ks = {r.k: (r.n_queries, round(r.recall_macro, 6)) for r in metrics.at_ks(ranked, want, (1, 3)).collect()}
    assert ks == {1: (3, 0.0), 3: (3, round(0.5 / 3, 6))}
    text = spark.createDataFrame([(0.5, "so (3.0 - 2) / 2"), (50.0, "(3 - 2) / 2 * 100, first (9 - 1)/1"), (1.5, "1500000 VND / 1e6"), (2.0, "1500000 / 1e6"), (None, "(3 - 2) / 2"), (1.0, "x"), (1.0, None), (1.0, "(1 - 1) / 0")], "e double, t string")
    assert [r.s for r in text.select(metrics.derivation_status(F.col("e"), F.col("t")).alias("s")).collect()] == ["pass", "fail", "pass", "fail", "no_expected_answer", "no_formula", "no_formula", "no_formula"]
