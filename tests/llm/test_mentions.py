import pytest

from ledgerloom.llm import mentions
from ledgerloom.llm.mentions import NONE, Matcher

LIST = [
    ("ZNC", "CTCP Chứng khoán Phác Gềnh"), ("WBV", "Công ty Cổ phần Gỗ nội thất Phác Gềnh"), ("JQ4", "Ngân hàng TMCP Phác Gềnh"), ("WP4", "Tập đoàn Cấp nước Ngọ Hoành Thoa - CTCP"),
    ("JDV", "CTCP Tập đoàn Đước Gềnh"), ("ZGN", "Tổng Công ty Dệt may Liễu Son - CTCP"), ("XDN", "Công ty Cổ phần Cao su Sâm Luyện"), ("WQE", "CTCP Tập đoàn Sâm Luyện"), ("JEK", "Ngân hàng TMCP Xuyến Thượng"),
]


def ask(name):
    return f"Năm 2016, {name} ghi nhận chi phí khác bao nhiêu VND?"


@pytest.mark.parametrize(
    "name,want",
    [
        ("CTCP Chứng khoán Phác Gềnh", "ZNC"), ("Chứng khoán Phác-Gềnh", "ZNC"), ("Phac Genh Securities JSC", "ZNC"), ("Phác Gềnh Gỗ nội thất", "WBV"), ("NHTMCP Phác Gềnh", "JQ4"), ("Nhà băng Xuyến Thượng", "JEK"),
        ("mã wp4", "WP4"), ("WP4", "WP4"), ("Ngọ  Hoành  Thoa", "WP4"), ("NgọHoànhThoa", "WP4"), ("Cấp nước Ngọ Hoành Tha", "WP4"), ("Ngo Hoanh Thoa Water Corp.", "WP4"), ("dioc genh", "JDV"),
        ("Tổng Cty Dệt may Liễu Son - CTCP (ZGN)", "ZGN"), ("Cao su Sâm uLyện", "XDN"), ("Tập đoàn Sâm Luyện", "WQE"), ("Ｃａｏ ｓｕ Ｓâｍ Ｌｕｙệｎ", "XDN"), ("CTTCP Chứng khoán Phác Gềnh", "ZNC"),
        ("QAX", NONE), ("mã qax", NONE), ("Nhựa Ngọ Hoành Thoa", NONE), ("Hóa chất Sâm Lũng Hợp", NONE), ("Thép Phác Gềnh", NONE),
    ],
)
def test_spellings(name, want):
    assert Matcher(LIST).found(ask(name)) == [want]


def test_two_names_and_none():
    m = Matcher(LIST)
    assert m.found("Giữa WP4 và Cao su Sâm Luyện, bên nào có cộng năm 2022 lớn hơn (trđ)?") == ["WP4", "XDN"]
    assert m.found("Trung bình hàng gửi bán toàn danh sách năm 2023 là mấy trđ?") == []
    assert m.found(None) == [] and m.found("") == [] and m.found("x" * 200_000) == []
    assert m.found("Tin mới về Ngọ Hoành Thoa hôm nay") == ["WP4"]
    assert Matcher([]).found(ask("WP4")) == [NONE]


def test_edits():
    assert mentions.edits("abcd", "abdc", 2) == 1 and mentions.edits("abc", "abc", 1) == 0 and mentions.edits("abc", "xyz", 1) == 2 and mentions.edits("a", "abcd", 2) == 3


def test_rows(spark):
    q = spark.createDataFrame([(1, ask("WP4"), "x"), (1, ask("WP4"), "x"), (2, None, "x"), (3, "", "x"), (4, ask("QAX"), "x")], "id bigint, question string, ticker string")
    c = spark.createDataFrame([*LIST, (None, "x"), ("y", None)], "ticker string, name string")
    assert sorted(map(tuple, mentions.map_mentions(q, c).collect())) == [(1, "WP4"), (4, NONE)]
    assert mentions.map_mentions(q.limit(0), c).count() == 0
    assert sorted(map(tuple, mentions.map_mentions(q, c.limit(0)).collect())) == [(1, NONE), (4, NONE)]


def test_cited_tables_name_the_company():
    """Of the questions whose answer cites a table, at least 97 in 100 are mapped to that table's company."""
    import duckdb

    con, sf = duckdb.connect(), "/root/testdata/sf0.01"
    m = Matcher(con.execute(f"SELECT ticker, name FROM '{sf}/companies.parquet'").fetchall())
    rows = con.execute(f"SELECT DISTINCT q.question, split_part(a.table_key, '_', 1) FROM '{sf}/dev_questions.parquet' q JOIN '{sf}/dev_answers.parquet' a USING (id) WHERE a.table_key IS NOT NULL").fetchall()
    right = sum(t in m.found(q) for q, t in rows)
    assert right >= 0.97 * len(rows)


@pytest.mark.parametrize(
    "name,want",
    [
        ("Hoành Thoa Ngọ", "WP4"), ("Thoa Hoành Ngọ Cấp nước", "WP4"), ("Cấp nước Hoành Thoa", "WP4"), ("Gềnh Phác Chứng khoán", "ZNC"), ("Thoa Hoanh Nggo", "WP4"), ("Sâm Luyện Việt Cao su", "XDN"),
        ("Nhựa Thoa Hoành Ngọ", NONE), ("Gềnh Phác", NONE), ("Chứng khoán Gềnh", NONE), ("Quế Luyện Nhị", NONE),
    ],
)
def test_token_sets(name, want):
    assert Matcher(LIST).found(ask(name)) == [want]


SHAPES = (
    "So sánh {} với {}", "Revenue of {} in 2020?", "Lợi nhuận quý 2 của {}", "{} doanh thu 2021?", "Vì sao cổ phiếu {} giảm mạnh tuần qua?", "Tôi muốn xem bảng cân đối kế toán {} các năm 2019-2021",
    "{} và {} công ty nào nợ ít hơn?", "Ai là chủ tịch của {}?", "Trong ba công ty {}, {} và {}, ai có vốn lớn nhất?", "Báo cáo hợp nhất 2022: {} lãi bao nhiêu?", "What was the net profit of {} for 2019?",
    "Did {} pay dividends last year?", "Xếp hạng tài sản: {}; {}.", "Đầu tư vào {} có rủi ro gì không?", "Theo thuyết minh, khoản vay từ {} là bao nhiêu?", "Hàng tồn kho {} cuối kỳ", "ROE {} 2023",
    "Tỷ lệ nợ trên vốn của {} so với {}", "Cho tôi doanh thu thuần ({}) quý 3/2021", "Nếu {} tăng vốn thì sao?",
)
OFF_LIST = ("Vinamilk", "CTCP Hóa chất Trăng Giang", "Ngân hàng TMCP Bình Minh", "Công ty Cổ phần Thép Quế Luyện", "VNM", "FPT", "Cty CP Bao bì Đông Á", "Hoà Phát Group", "Tập đoàn Hoa Sen", "Sâm Nguồn Seafood JSC")


def _typed(rng, ticker, name):
    """One way of writing an entry: code, whole, short, a doubled letter, without accents, another legal form, tokens of the brand reversed."""
    core = name
    for form in ("Công ty Cổ phần ", "CTCP ", "Tổng Công ty ", " - CTCP"):
        core = core.replace(form, "")
    core = core.replace("Ngân hàng TMCP", "Ngân hàng")
    at = rng.randrange(1, len(core) - 1)
    return rng.choice((ticker, name, core, core[:at] + core[at] + core[at:], mentions.fold_text(name), f"CTCP {core}" if not core.startswith("Ngân") else core.replace("Ngân hàng", "NHTMCP")))


def test_any_sentence_shape():
    """1,000 questions in shapes the data does not have: precision and recall of 0.95 at least (measured: 0.998 and 0.995)."""
    import random

    import duckdb

    entries = duckdb.sql("SELECT ticker, name FROM '/root/testdata/sf0.01/companies.parquet' ORDER BY 1").fetchall()
    m, rng = Matcher(entries), random.Random(5)
    both = got = want = 0
    for i in range(1000):
        shape = SHAPES[i % len(SHAPES)]
        asked = [(rng.choice(OFF_LIST), NONE) if rng.random() < 0.25 else (lambda e: (_typed(rng, *e), e[0]))(rng.choice(entries)) for _ in range(shape.count("{}"))]
        found, truth = set(m.found(shape.format(*(n for n, _ in asked)))), {t for _, t in asked}
        both, got, want = both + len(found & truth), got + len(found), want + len(truth)
    assert both >= 0.95 * got and both >= 0.95 * want


@pytest.mark.parametrize(
    "text,want",
    [
        ("So sánh WP4 với ZNC", ["WP4", "ZNC"]), ("Revenue of JDV in 2020?", ["JDV"]), ("Lợi nhuận quý 2 của Công ty Cổ phần Cao su Sâm Luyệx", ["XDN"]), ("Lợi nhuận quý 2 của Vinamilk", [NONE]),
        ("VNM doanh thu 2021?", [NONE]), ("Doanh thu của Thoa Hoành Ngọ quý 3", ["WP4"]), ("TỔNG CỘNG TÀI SẢN NGẮN HẠN là bao nhiêu?", []), ("Cổ phần là gì?", []), ("vay ngân hàng trong nước của xdn", ["XDN"]),
    ],
)
def test_without_templates(text, want):
    assert Matcher(LIST).found(text) == want
