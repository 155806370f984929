"""Extraction, normalization, files and streams on small texts of our own."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import extract, normalize
from ledgerloom.sources import files
from ledgerloom.streaming import ingest

TEXT = """===== PAGE 1 =====
BÁO CÁO TÌNH HÌNH TÀI CHÍNH
Đơn vị tính: triệu đồng
<table><tr><td>Chỉ tiêu</td><td>31/12/2020</td><td>01/01/2020</td></tr><tr><td>Tiền</td><td>1.234</td><td>(5)</td></tr></table>

===== PAGE 2 =====
Một dòng

Thuyết minh 4: Vay
Hai dòng
<table><tr><td rowspan=2>Bên</td><td colspan="2">Năm 2020 (VND)</td></tr><tr><td>Vay</td><td>Trả</td></tr><tr><td>A<td>1</td></tr></table>
<table>
<table></table>
"""


@pytest.fixture
def reports(spark):
    return spark.createDataFrame([("X_2020_separate", "p/X/f.txt", TEXT, 1), ("EMPTY", "p", "", 1), ("NULL", "p", None, 1)], "report_id string, source_path string, content string, page int")


def test_candidates(reports):
    got = [r.asDict() for r in extract.candidates(reports).orderBy("line_position").collect()]
    assert [r["line_position"] for r in got] == [4, 11, 13]
    a, b, c = got
    assert (a["page"], a["section_header"], a["status"], a["n_rows"], a["n_cols"]) == (1, "balance_sheet", "success", 2, 3)
    assert a["caption_context"] == ["BÁO CÁO TÌNH HÌNH TÀI CHÍNH", "Đơn vị tính: triệu đồng"] and a["preceding_unit_declaration"] == "Đơn vị tính: triệu đồng"
    assert b["grid"] == [["Bên", "Năm 2020 (VND)", "Năm 2020 (VND)"], ["Bên", "Vay", "Trả"], ["A", "1", ""]]
    assert b["caption_context"] == ["Một dòng", "Thuyết minh 4: Vay", "Hai dòng"] and b["section_header"] == "notes" and b["status"] == "parsed_with_warnings" and b["warnings"] == ["cell closed by next cell"]
    assert c["status"] == "failed" and c["grid"] == [] and c["page"] == 2


@pytest.mark.parametrize(
    "html,compat,grid",
    [
        ("<table><tr><td>a</tr><tr><td>b</td></tr></table>", False, [["a"], ["b"]]),
        ("<table><tr><td>a</tr><tr><td>b</td></tr></table>", True, [["", ""], ["a", "b"]]),
        ("<table><tr><td>a</td></table>", False, [["a"]]),
        ("<table><tr><td>a</td></table>", True, []),
        ("<table><tr><td rowspan=x>a</td></tr></table>", False, [["a"]]),
        ("<td>a</td>", False, [["a"]]),
        ("<table><tr><td rowspan=3>a</td><td>b</td></tr></table>", False, [["a", "b"], ["a", ""], ["a", ""]]),
        ("<table><tr><td>a &amp; b&lt;</td><p>x</p></tr></table>", False, [["a & b<"]]),
        ("<table><tr><td colspan=900000 rowspan=900000>a</td></tr></table>", False, []),
        ("<table><tr><td>a<tr><td>b</table>", False, [["a"], ["b"]]), ("<tr><td>a</td><td>b</td>", True, []), ("<td>a</td><td>b</td></tr>", True, [["a", "b"]]), ("<tr></tr><tr><TD colspan='2'>a<br>b &nbsp;</TD></tr>", False, [["", ""], ["ab", "ab"]]),
        ("<tr><td title='a > b'>x</td><!-- <td>no</td> --><td data-colspan=3>y</td></tr>", False, [["x", "y"]]), ("<tr><td rowspan=0>a</td><td>b</td></tr>", False, [["", "b"]]),
        ("", False, []),
    ],
)
def test_lenient_markup(html, compat, grid):
    assert extract.parse_table(html, compat)[2] == grid


def test_normalized(reports, spark):
    names = spark.createDataFrame([("X", "Công ty X")], "ticker string, name string")
    got = {r.line_position: r for r in normalize.normalize(extract.candidates(reports), names).collect()}
    a, b, c = got[4], got[11], got[13]
    assert (a.table_key, a.ticker, a.year, a.variant, a.part) == ("X_2020_separate|4", "X", 2020, "separate", None)
    assert [p.label for p in a.period_labels] == ["31/12/2020", "01/01/2020"] and [r.label for r in a.row_labels] == ["Chỉ tiêu", "Tiền"]
    assert [(m.source_unit, m.scale_to_vnd) for m in a.column_metadata] == [("triệu đồng", 10**6)] * 3
    assert b.detected_units == ["VND"] and b.column_metadata[1].scale_to_vnd == 1 and b.header_depth == 2
    assert a.retrieval_text.startswith("TICKER X. COMPANY Công ty X. YEAR 2020. VARIANT separate. SECTION balance_sheet. CAPTION ")
    assert c.row_labels == [] and c.column_metadata == [] and c.header_depth == 0 and c.searchable_text == ""
    assert a.header_depth == 1


@pytest.mark.parametrize(
    "rid,want",
    [("A_financial_statements_2020_consolidated_3", ("A", 2020, "consolidated", 3)), ("A_2019_explanatory_letters", ("A", 2019, "explanatory", None)), ("A_financial_statements_2021", ("A", 2021, "unspecified", None)), ("x", ("x", None, "unspecified", None))],
)
def test_report_ids(spark, rid, want):
    r = spark.createDataFrame([(rid,)], "r string").select(*[c.alias(k) for k, c in normalize.report_parts(F.col("r")).items()]).first()
    assert tuple(r) == want


def test_word_anchored_scale(spark):
    df = spark.createDataFrame([("loyalty",), ("tỷ đồng",), ("hoạt động",)], "u string")
    got = [(r.a, r.b) for r in df.select(normalize.unit_scale(F.col("u")).alias("a"), normalize.unit_scale(F.col("u"), True).alias("b")).collect()]
    assert got == [(10**9, None), (10**9, 10**9), (1, 1)]


def test_lookup_fails_on_a_missing_key(spark):
    store = spark.createDataFrame([("a", 1), ("b", 2)], "table_key string, v int")
    keys = spark.createDataFrame([("a",), ("a",)], "table_key string")
    assert [tuple(r) for r in normalize.lookup(store, keys).collect()] == [("a", 1)]
    with pytest.raises(Exception, match="not in the store"):
        normalize.lookup(store, spark.createDataFrame([("z",)], "table_key string")).collect()


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a "b", c', [1]), (1, "", None)], "id int, t string, a array<int>")
    files.write_rows(df, str(tmp_path / "j"))
    assert sorted(map(tuple, files.read_jsonl(spark, str(tmp_path / "j"), df.schema).collect())) == [(1, "", None), (2, 'a "b", c', [1])]
    files.write_rows(df, str(tmp_path / "c"), "csv")
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), "id int, t string, a string").select("id", "t").collect())) == [(1, ""), (2, 'a "b", c')]
    assert files.write_single_json(df, str(tmp_path / "o" / "x.json"), ["id"]) == 2
    assert [r["id"] for r in json.loads((tmp_path / "o" / "x.json").read_text())] == [1, 2]
    assert files.read_json_array(spark, str(tmp_path / "o" / "x.json"), df.schema).count() == 2
    assert files.zip_package(str(tmp_path / "o" / "x.json"), str(tmp_path / "c"), str(tmp_path / "p.zip"))[0] == "x.json"
    with pytest.raises(ValueError):
        files.write_single_json(df, str(tmp_path / "y.json"), ["id"], most=1)
    (tmp_path / "r.csv").write_text("Mã CK,Tên công ty,x\nA,Công ty A,1\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_registry(spark, str(tmp_path / "r.csv")).collect()] == [("A", "Công ty A")]
    (tmp_path / "k.json").write_text('{"7": [["a|1", 2.5], ["b|2", 1]]}')
    assert [tuple(r) for r in files.read_rankings(spark, str(tmp_path / "k.json")).orderBy("rank").collect()] == [("7", 1, "a|1", 2.5), ("7", 2, "b|2", 1.0)]
    assert files.fingerprint(df, ["id", "t"]) == files.fingerprint(df.repartition(3), ["id", "t"]) != files.fingerprint(df.limit(1), ["id", "t"])


def test_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    def put(name, text):
        d = tmp_path / "in" / name
        d.mkdir(parents=True)
        (d / f"{name}_extracted.txt").write_text(text, encoding="utf-8")

    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    put("X_2020_separate", TEXT)
    ingest.ingest(spark, str(tmp_path / "in"), out, state).awaitTermination()
    put("Y_2021", TEXT)
    ingest.ingest(spark, str(tmp_path / "in"), out, state).awaitTermination()
    ingest.ingest(spark, str(tmp_path / "in"), out, state).awaitTermination()
    streamed = sorted((r.table_key, r.n_rows) for r in spark.read.parquet(out).collect())
    assert len({p.name for p in (tmp_path / "out").iterdir() if p.is_dir()}) == 2 and ingest.latest(spark.read.parquet(out)).count() == 6
    batch = extract.candidates(extract.read_reports(spark, str(tmp_path / "in")))
    assert streamed == sorted((f"{r.report_id}|{r.line_position}", r.n_rows) for r in batch.collect()) and len(streamed) == 6


def test_stream_windows_equal_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    s = spark.readStream.schema(e.schema).parquet("/root/testdata/sf0.001", pathGlobFilter="events.parquet")
    q = ingest.windowed_counts(s).writeStream.outputMode("complete").format("memory").queryName("w").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (str(r.window_start), r.event_type, r.n)
    assert sorted(map(key, spark.table("w").collect())) == sorted(map(key, ingest.windowed_counts(e).collect()))


def test_large_spans_are_expanded_whole():
    status, notes, grid = extract.parse_table("<tr><td rowspan=300 colspan=700>a</td><td>b</td></tr>")
    assert status == "success" and notes == [] and len(grid) == 300 and all(r[:700] == ["a"] * 700 for r in grid) and grid[0][700] == "b" and grid[1][700] == ""
    assert extract.parse_table("<tr><td rowspan=90000 colspan=90000>a</td></tr>")[:2] == ("failed", [f"ValueError: a grid of more than {extract.LARGEST_GRID} cells"])


def test_parsed_grids_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "<tr><td>a</td></tr>", "x"), (2, None, None)], "id int, text string, status2 string")
    got = {r.id: (r.status, r.grid, r.status2) for r in extract.parsed_grids(df).collect()}
    assert got == {1: ("success", [["a"]], "x"), 2: ("failed", [], None)}
