"""Dense retrieval, fusion, packages and the command line on small cases of our own."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom import __main__ as shell
from ledgerloom.operators import dense, package, rank
from ledgerloom.plans import jobs

from .test_ground import ASKED, companies, tables


def letters(texts):
    """An encoder of our own: counts of letters."""
    return np.array([[1.0 + t.lower().count(c) for c in "aeioungh"] for t in texts])


def test_encoded_in_batches(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "nghe"), (4, "")], "id int, text string")
    got = {r.id: r.vector for r in dense.encoded(df, "text", letters, batch=2).collect()}
    for i, t in ((1, "abc"), (2, ""), (3, "nghe")):
        v = letters([t])[0]
        assert np.allclose(got[i], v / np.linalg.norm(v), atol=1e-6)
    assert dense.encoded(df.limit(0), "text", letters).count() == 0
    with pytest.raises(ValueError):
        dense.encoded(df, "text", letters, batch=0)
    with pytest.raises(Exception, match="one vector per text"):
        dense.encoded(df.coalesce(1), "text", lambda t: np.ones((1, 2))).collect()
    with pytest.raises(Exception, match="without direction"):
        dense.encoded(df, "text", lambda t: np.zeros((len(t), 2))).collect()


def test_vectors_are_kept_while_the_documents_are_the_same(spark, tmp_path):
    t, path = tables(spark).withColumn("retrieval_text", F.col("searchable_text")), str(tmp_path / "v")
    first = {r.doc_id: r.vector for r in dense.build_vectors(t, letters, path).collect()}
    assert len(first) == 5
    same = {r.doc_id: r.vector for r in dense.build_vectors(t, lambda x: letters(x)[:, ::-1], path).collect()}
    assert same == first  # not encoded again
    more = dense.build_vectors(t.filter("ticker = 'AAA'"), letters, path, companies(spark))
    assert more.count() == 4
    out = str(tmp_path / "m.npy")
    assert dense.write_npy(more, out) == 4
    back = {r.doc_id: r.vector for r in dense.read_npy(spark, out).collect()}
    assert back == {r.doc_id: r.vector for r in more.collect()}
    with pytest.raises(ValueError):
        dense.write_npy(more, out, most=3)


def test_dense_rankings_keep_to_the_scope(spark):
    v = dense.encoded(tables(spark).select(F.col("table_key").alias("doc_id"), "ticker", "year", "variant", "searchable_text"), "searchable_text", letters)
    q = spark.createDataFrame([*ASKED, (20, "AAA và BBB năm 2020"), (21, "CCC"), (1, ASKED[0][1])], "id int, question string")
    got = {}
    for r in dense.dense_rankings(q, companies(spark), v, letters, k=3).collect():
        got.setdefault(r.id, []).append((r["rank"], r.table_key))
    assert {k for _, k in got[1]} == {"A_2020|1"} and {k for _, k in got[2]} == {"A_2020c|1"} and {k for _, k in got[20]} == {"A_2020|1", "A_2020c|1", "B_2020|1"} and 21 not in got and len(got[9]) == 3
    assert all(sorted(p for p, _ in x) == list(range(1, len(x) + 1)) for x in got.values())


def test_fused_needs_the_same_questions(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "id int, table_key string, rank int")
    b = spark.createDataFrame([(1, "y", 1), (1, "w", 2), (1, "v", 3), (2, "z", 1)], "id int, table_key string, rank int")
    got = sorted((r.id, r["rank"], r.table_key, r.source) for r in dense.fused(a, b, 1).collect())
    assert got == [(1, 1, "x", "primary"), (1, 2, "y", "primary"), (1, 3, "w", "secondary"), (2, 1, "z", "primary")]
    with pytest.raises(ValueError, match="question 2"):
        dense.fused(a, b.filter("id = 1"))


def test_label_text(spark):
    df = spark.createDataFrame([(["a", "b", None, "", "a", "x" * 300],), (None,), ([],)], "l array<string>")
    got = [r.t for r in df.select(rank.label_text(F.col("l")).alias("t")).collect()]
    assert got == ["a | b | " + "x" * 199 + "…", "", ""]


def test_records_of_a_package(spark):
    schema = "id int, relevant_tables array<string>, relevant_docs array<string>, evidence array<struct<variable:string,path:string>>, query string"
    ok = (["A|1"], ["A"], [("t1", "data/A_1.csv")], "cell(t1, 1, 2) * 0.001")
    rows = [
        (1, *ok), (2, [], ["A"], *ok[2:]), (3, ["A|1", "A1"], ["A"], *ok[2:]), (4, ["A|1"], ["B"], *ok[2:]), (5, *ok[:2], [], "1"), (6, *ok[:2], [("t1", "/data/x.csv")], ok[3]), (7, *ok[:2], [("t1", "data/../x.csv")], ok[3]),
        (8, *ok[:2], [("1t", "data/x.csv")], ok[3]), (9, *ok[:3], "cell(t2, 1, 2)"), (10, *ok[:3], "open(t1)"), (11, *ok[:2], [("t1", "data/a"), ("t1", "data/b")], ok[3]), (12, None, None, None, None), (13, ["A|1"], ["A", "A"], *ok[2:]),
    ]
    got = {}
    for r in package.check_records(spark.createDataFrame(rows, schema)).collect():
        got.setdefault(r.id, set()).add(r.error)
    assert 1 not in got and "no tables" in got[2] and "bad table key" in got[3] and got[4] == {"documents differ"} and "no evidence" in got[5] and got[6] == got[7] == {"path outside data"} and "bad variable" in got[8]
    assert got[9] == {"variables differ"} and got[10] == {"query not allowed"} and got[11] == {"variable twice"} and {"no tables", "no documents", "no evidence"} <= got[12] and "documents twice" in got[13]


def test_refusals(spark):
    q = spark.createDataFrame([(i, "q") for i in range(1, 6)], "id int, question string")
    p = spark.createDataFrame([(1, "q", 1.0, True), (2, "q", None, False), (3, "r", 1.0, True), (4, "q", float("inf"), True)], "id int, question string, answer double, executed boolean")
    assert {r.id: r.error for r in package.refusals(q, p).collect()} == {2: "not executed", 3: "question differs", 4: "not finite", 5: "missing prediction"}
    assert {r.id for r in package.refusals(q, p, True).collect()} == {3, 4}


def test_from_the_shell(spark, tmp_path):
    """Reports to a package by the command line, then purged."""
    d = tmp_path / "in" / "AAA_financial_statements_2020_separate"
    d.mkdir(parents=True)
    (d / "x_extracted.txt").write_text("BẢNG CÂN ĐỐI KẾ TOÁN\nĐơn vị tính: triệu đồng\n<table><tr><td>Chỉ tiêu</td><td>Năm 2020</td></tr><tr><td>Vốn chủ sở hữu</td><td>1.500</td></tr></table>\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("Mã CK,Tên công ty\nAAA,Công ty Alphax\n", encoding="utf-8")
    (tmp_path / "q.jsonl").write_text(json.dumps({"id": 7, "question": "Vốn chủ sở hữu của AAA năm 2020 là bao nhiêu tỷ đồng?"}) + "\n" + json.dumps({"id": 8, "question": "AAA năm 2011?"}) + "\n", encoding="utf-8")
    out = str(tmp_path / "out")
    assert shell.main(["build", "--reports", str(tmp_path / "in"), "--out", out, "--companies", str(tmp_path / "c.csv")]) == 0
    rest = ["--questions", str(tmp_path / "q.jsonl"), "--catalog", f"{out}/catalog", "--companies", str(tmp_path / "c.csv"), "--out", out]
    for job in ("rank", "answer", "repair"):
        assert shell.main([job, *rest]) == 0
    with pytest.raises(ValueError, match="8: not executed"):
        shell.main(["package", "--out", out])
    assert shell.main(["package", "--out", out, "--allow-partial"]) == 0
    (record,) = json.loads((tmp_path / "out" / "package.json").read_text(encoding="utf-8"))
    assert record["answer"] == 1.5 and record["query"] == "cell(t1, 1, 1) * 0.001" and record["evidence"] == [{"variable": "t1", "path": "data/AAA_financial_statements_2020_separate_3.csv"}]
    assert shell.main(["purge", "--out", out]) == 0 and jobs.purge(spark, out) == []
