"""Search, scope, linking, plans and metrics on small cases of our own."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import number, tokens, truncated
from ledgerloom.operators import index, link, metrics, package, plan, rank, scope, together


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("v")).first().v


def test_text_builders(spark):
    assert one(spark, tokens, "Lợi nhuận, A_1 A_1!") == ["lợi", "nhuận", "a_1", "a_1"]
    assert one(spark, tokens, None) == [] and one(spark, lambda c: truncated(c, 5), "abcdefg") == "abcd…" and one(spark, lambda c: truncated(c, 5), "abcde") == "abcde"


@pytest.mark.parametrize("text,want", [("(1.234.000)", -1234000.0), ("12,5%", 12.5), ("-", None), ("1.234", 1234.0), ("1,234", 1234.0), ("1.234,56", 1234.56), ("1,234.5", 1234.5), ("5.1", 5.1), ("31/12/2020", 31122020.0), ("31.12.2020", None), ("1-2", None), ("Năm 2023", 2023.0), ("", None), (None, None)])
def test_number(spark, text, want):
    assert one(spark, number, text) == want


def bm25(docs, query, k1=1.5, b=0.75):
    toks = {d: t.lower().split() for d, t in docs.items()}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    out = {}
    for d, t in toks.items():
        tf, s = Counter(t), 0.0
        for w in query.lower().split():
            if tf[w]:
                nt = sum(w in x for x in toks.values())
                s += math.log(1 + (n - nt + 0.5) / (nt + 0.5)) * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / avg))
        if s:
            out[d] = s
    return out


def test_bm25_against_brute_force(spark):
    docs = {"1": "vay vay ngắn hạn", "2": "vay dài hạn", "3": "tiền mặt", "4": "", "10": "vay dài hạn"}
    d = spark.createDataFrame([("s", k, t, 1) for k, t in docs.items()] + [("other", "9", "vay vay vay", 1), ("s2", "8", None, 1)], "scope string, doc_id string, text string, f int")
    q = spark.createDataFrame([(1, "s", "vay vay hạn"), (2, "s", "không"), (3, "none", "vay"), (4, "s", None)], "query_id int, scope string, text string")
    got = index.ranked(index.bm25(d, q, stop=()), None)
    rows = {(r.query_id, r.doc_id): (r.score, r.rank) for r in got.collect()}
    want = bm25(docs, "vay vay hạn")
    assert set(rows) == {(1, k) for k in want} and all(abs(rows[1, k][0] - v) < 1e-8 for k, v in want.items())
    assert rows[1, "10"][1] < rows[1, "2"][1]  # a tie, by key as text
    assert index.bm25(d.limit(0), q).count() == 0


def test_questions(spark):
    assert one(spark, scope.years, "từ 2019 đến 2021 và 2015") == [2015, 2019, 2020, 2021] and one(spark, scope.years, "2021-2019") == [2019, 2021] and one(spark, scope.years, None) == []
    assert one(spark, scope.variant, "Báo cáo công ty mẹ của tập đoàn") == "separate" and one(spark, scope.variant, "HỢP NHẤT") == "consolidated" and one(spark, scope.variant, "x") is None
    assert one(spark, scope.literal_codes, "HT1, CTCP và ABC năm 2020 ĐABC") == ["HT1", "ABC"]
    q = spark.createDataFrame([(1, "ROE và tổng tài sản cố định"), (2, "Tổng tài sản"), (3, None)], "id int, question string")
    got = {r.id: r.concepts for r in scope.concepts(q).collect()}
    assert got == {1: ["vốn chủ sở hữu", "lợi nhuận sau thuế", "tài sản cố định"], 2: ["tổng tài sản"], 3: []}


def test_tickers(spark):
    c = spark.createDataFrame([("FPT", "Công ty Cổ phần Sao Mai"), ("FTS", "CTCP Chứng khoán FPT"), ("AAA", "Tập đoàn Biển Đông Xanh"), ("BBB", "Tập đoàn Biển Đông"), ("CCC", "CTCP Vinhomesx")], "ticker string, name string")
    q = spark.createDataFrame([(1, "Chứng khoán FPT lãi bao nhiêu"), (2, "AAA và Biển Đông Xanh"), (3, "Biển Đông Xanh"), (4, "vinhomesx"), (5, "không có"), (6, None), (7, "FPT")], "id int, question string")
    got = {r.id: r.tickers for r in scope.resolved_tickers(q, c).collect()}
    assert got == {1: ["FTS"], 2: ["AAA"], 3: ["AAA"], 4: ["CCC"], 5: [], 6: [], 7: ["FPT"]}


def test_fusion(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "query_id int, doc_id string, rank int")
    b = spark.createDataFrame([(1, "y", 1), (1, "z", 2), (1, "z", 3), (2, "w", 1)], "query_id int, doc_id string, rank int")
    f = rank.rrf(a.unionByName(b.limit(2)), 2).collect()
    assert [r.doc_id for r in sorted(f, key=lambda r: r["rank"])] == ["y", "x"]
    back = sorted((r.query_id, r["rank"], r.doc_id, r.source) for r in rank.backfilled(a, b, 5).collect())
    assert back == [(1, 1, "x", "primary"), (1, 2, "y", "primary"), (1, 3, "z", "secondary"), (2, 1, "w", "secondary")]
    with pytest.raises(ValueError):
        rank.rrf(a, 0)


def test_nearest(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [2.0, 0.1], 0), (3, [0.0, 1.0], 1)], "doc_id int, vector array<float>, scope int")
    q = spark.createDataFrame([(9, [3.0, 0.0], 0)], "query_id int, vector array<float>, scope int")
    assert [r.doc_id for r in rank.nearest(v.drop("scope"), q.drop("scope"), 3).orderBy("rank").collect()] == [1, 2, 3]
    assert rank.nearest(v, q, 3, scoped=True).count() == 2
    with pytest.raises(Exception, match="without direction"):
        rank.nearest(v.unionByName(spark.createDataFrame([(4, [0.0, 0.0], 0)], v.schema)), q, 3, True).collect()


@pytest.mark.parametrize("bad", ["__import__('os')", "a.b", "a[0]", "a if a else b", "x + 1", "abs(a, b)", "a <", "True", "'s'", "lambda: 1", "a % b", "max(a, b)"])
def test_expressions_outside_the_whitelist(bad):
    with pytest.raises(plan.PlanError):
        plan.checked(bad, {"a", "b"})


def test_expressions(spark):
    df = spark.createDataFrame([(6.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    cols = {"a": F.col("a"), "b": F.col("b")}
    got = lambda e: [r.v for r in df.select(plan.compiled(e, cols).alias("v")).collect()]
    assert got("a / b") == [3.0, None, None] and got("-abs(b - a) * 2 ** 3") == [-32.0, -8.0, None] and got("a ** 10000") == [None, 1.0, None]


def test_reductions_and_errors(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 3.0), ("g", None), ("h", None)], "k string, value double")
    r = plan.reduced(df, [("s", "sum", None), ("a", "avg", None), ("m", "max", None), ("n", "count_ge", 3.0)], ["k"])
    assert {tuple(x) for x in r.collect()} == {("g", 4.0, 2.0, 3.0, 1.0), ("h", 0.0, 0.0, None, 0.0)}
    for bad in ([("s", "median", None)], [("s", "count_gt", None)]):
        with pytest.raises(plan.PlanError):
            plan.reduced(df, bad, ["k"])
    p = spark.createDataFrame([(1, "x", "t", 1, 1), (1, "x", "t", 1, 2), (1, "9a", "t", 5, 5)], "id int, alias string, table_key string, row_index int, column_index int")
    allowed = spark.createDataFrame([(1, "t", 1, 1), (1, "t", 1, 2)], "id int, table_key string, row_index int, column_index int")
    assert {tuple(x) for x in plan.coordinate_errors(p, allowed).collect()} == {(1, "x", "duplicate alias"), (1, "9a", "not an identifier"), (1, "9a", "cell not allowed")}


TABLE = "table_key string, ticker string, year int, variant string, table_identity string, grid array<array<string>>, row_labels array<struct<row_index:int,column_index:int,label:string>>, column_metadata array<struct<column_index:int,header_path:string>>"


def test_linking_and_lookup(spark):
    grid = [["Chỉ tiêu", "Mã số", "2020", "2019"], ["Tiền mặt", "100", "1.000", "500"], ["Vay ngắn hạn", "110", "(7)", ""]]
    labels = [(0, 0, "Chỉ tiêu"), (1, 0, "Tiền mặt"), (2, 0, "Vay ngắn hạn")]
    t = spark.createDataFrame([("X|1", "X", 2020, "separate", "cân đối", grid, labels, None), ("X|2", "X", 2018, "consolidated", None, grid, labels, [(2, "Thuyết minh")]), ("X|3", None, None, None, None, None, None, None), ("X|4", "X", 1, None, None, [], [], [])], TABLE)
    cells = link.value_cells(t)
    assert {(r.table_key, r.row_index, r.column_index) for r in cells.collect()} == {("X|1", 0, 2), ("X|1", 0, 3), ("X|1", 1, 2), ("X|1", 1, 3), ("X|1", 2, 2), ("X|2", 0, 3), ("X|2", 1, 3)}
    q = spark.createDataFrame([(1, "Tiền mặt năm 2020 của X"), (2, "abc")], "id int, question string")
    pairs = spark.createDataFrame([(1, "X|1"), (1, "X|2"), (1, "X|1"), (2, "X|1")], "id int, table_key string")
    ops = link.ordered(link.operands(q, pairs, cells), scope.concepts(q))
    first = [(r.table_key, r.row_index, r.column_index, r.tier) for r in ops.filter("id = 1").orderBy("pos").collect()]
    assert first[0] == ("X|1", 1, 2, 0) and first[-1][3] == 1
    assert ops.filter("id = 2").count() == 5  # no positive score, so all stay
    best = {r.id: (r.table_key, r.row_index, r.column_index, r.numeric_value) for r in plan.direct_lookup(link.operands(q, pairs, cells), q).collect()}
    assert best[1] == ("X|1", 1, 2, 1000.0)
    assert [tuple(r) for r in link.relevant_tables(ops.filter("id = 1")).collect()][0] == (1, "X|1", 1)


def test_metrics(spark):
    got = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (3, "z")], "query_id int, key string")
    rel = spark.createDataFrame([(1, "a"), (1, "c"), (2, "x")], "query_id int, key string")
    m = {r.query_id: (r.precision, r.recall, round(r.f2, 6)) for r in metrics.prf(got, rel).collect()}
    assert m == {1: (0.5, 0.5, 0.5), 2: (0.0, 0.0, 0.0)}
    df = spark.createDataFrame([(1.0, 1.0 + 1e-9), (1.0, 1.1), (None, 1.0), (float("nan"), float("nan"))], "a double, b double")
    assert [r.c for r in df.select(metrics.close(F.col("a"), F.col("b")).alias("c")).collect()] == [True, False, False, False]


def test_package_checks(spark):
    q = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, question string")
    a = spark.createDataFrame([(1, 1.0), (2, float("inf"))], "id int, answer double")
    t = spark.createDataFrame([(1, "r|s|5", 1), (1, "r|s|7", 2)], "id int, table_key string, rank int")
    p = package.assembled(q, a, t)
    assert p.filter("id = 1").first().relevant_docs == ["r|s"]
    bad = p.filter("id < 3").unionByName(p.filter("id = 1").withColumn("id", F.lit(9)))
    got = {tuple(r) for r in package.check(bad, q, a.withColumn("answer", F.lit(2.0))).collect()}
    assert got == {(9, "unknown id"), (3, "missing"), (2, "not finite"), (1, "answer differs"), (2, "answer differs")}


def test_letters_compose_as_in_nfc(spark):
    """Decomposed Vietnamese gives the same concepts, tokens and units as composed text."""
    import unicodedata

    from ledgerloom.functions.text import composed
    from ledgerloom.operators import link, scope

    texts = ["Vòng quay tổng tài sản của ABC năm 2020", "lợi nhuận sau thuế và Doanh thu thuần", "ÁẬỄỞỰỲ đ", "ậ ộ ệ x̂", "", None, "café\n", "́", "plain"]
    rows = [(i, t, unicodedata.normalize("NFD", t) if t is not None else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    for r in df.select("a", composed(F.col("b")).alias("b"), composed(F.col("a")).alias("c")).collect():
        want = unicodedata.normalize("NFC", r.a) if r.a is not None else None
        assert r.b == r.c == want
    both = [{r.id: r.concepts for r in scope.concepts(df.select("id", F.col(c).alias("question"))).collect()} for c in "ab"]
    assert both[0] == both[1] and both[0][0] and both[0][1]
    pair = df.select(link.question_tokens(F.col("a")).alias("a"), link.question_tokens(F.col("b")).alias("b")).collect()
    assert all(r.a == r.b for r in pair)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_top_documents_equal_the_ranked_joins(spark, limit):
    """Blocks and shuffle joins give the same rows; ties, repeated documents' texts, empty texts and several scopes included."""
    import random

    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("ab cd ef gh ij kl mn op".split()) for _ in range(rng.randrange(n)))
    rows = [(rng.choice("xyz"), i, text(12), "clash") for i in range(400)] + [("x", 900 + i, "ab ab cd", "") for i in range(30)] + [("x", 999, None, "")]
    docs = spark.createDataFrame(rows, "scope string, doc_id bigint, text string, t2 string").repartition(3)
    q = spark.createDataFrame([(i, rng.choice("xyzw"), text(6)) for i in range(40)] + [(99, "x", "ab"), (98, "x", ""), (97, "x", None)], "query_id bigint, scope string, text string")
    got = index.top_documents(docs, q, 7, limit=limit)
    want = index.ranked(index.bm25(docs, q), 7, ("query_id", "scope"))
    key = lambda r: (r.query_id, r.scope, r.doc_id, round(r.score, 6), r["rank"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert index.top_documents(docs, q.limit(0), 7, limit=limit).count() == 0 and index.top_documents(docs.limit(0), q, 7, limit=limit).count() == 0


@pytest.mark.parametrize("limit", [1 << 26, 300])
@pytest.mark.parametrize("scoped", [False, True])
def test_nearest_against_brute_force(spark, limit, scoped):
    import random

    rng = random.Random(3)
    vec = lambda: [rng.choice((-1.0, 0.5, 2.0)) for _ in range(4)]
    docs = [(i, vec(), rng.choice(("a", "b", None))) for i in range(200)]
    asked = [(1000 + i, vec(), rng.choice(("a", "b", "c"))) for i in range(25)]
    d = spark.createDataFrame(docs, "doc_id bigint, vector array<float>, scope string").repartition(3)
    q = spark.createDataFrame(asked, "query_id bigint, vector array<float>, scope string")
    got = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in rank.nearest(d, q, 5, scoped, limit=limit).collect()}
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)), 6)
    for i, v, s in asked:
        best = sorted(((-cos(v, w), str(j), j) for j, w, t in docs if not scoped or s == t))[:5]
        assert [got[i, k + 1][0] for k in range(len(best))] == [b[2] for b in best] and (i, len(best) + 1) not in got
    assert rank.nearest(d, q.limit(0), 5, scoped).count() == 0 and rank.nearest(d.limit(0), q, 5, scoped).count() == 0


@pytest.mark.parametrize("bad", [None, [0.0, 0.0, 0.0, 0.0], [1.0]])
def test_vectors_without_direction_fail(spark, bad):
    d = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 1.0]), (2, bad)], "doc_id bigint, vector array<float>").coalesce(1)
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 1.0])], "query_id bigint, vector array<float>")
    with pytest.raises(Exception, match="without direction|different lengths"):
        rank.nearest(d, q, 5).collect()


def _scoped_sides(spark, words=40, n=300):
    rng = np.random.default_rng(5)
    text = lambda size: [f"w{x}" for x in rng.integers(0, words, size)]
    docs = [(f"d{i}", ["*", "ab"[i % 2]], text(rng.integers(0, 20)), [text(rng.integers(0, 4)) for _ in range(rng.integers(0, 4))], ["notes", "balance_sheet", None][i % 3], ["Bên liên quan", None][i % 2]) for i in range(n)]
    docs = [(*d[:3], [list(dict.fromkeys(x)) for x in d[3]], *d[4:]) for d in docs]
    queries = [(i, s, " ".join(text(6)) + (" bên liên quan" if i % 4 == 0 else "")) for i in range(30) for s in (["*"], ["a", "b"], ["none"])[i % 3]] + [(90, "a", None), (91, "*", "w1 w1 w1"), (92, "a", "unknown")]
    return spark.createDataFrame(docs, "doc_id string, scopes array<string>, t array<string>, label_sets array<array<string>>, section string, identity string"), spark.createDataFrame(queries, "query_id int, scope string, text string")


@pytest.mark.parametrize("pairs", [50_000_000, 100])
def test_pairs_scored_together_equal_joins(spark, monkeypatch, pairs):
    monkeypatch.setattr(together, "PAIRS", pairs)  # 100 cuts the queries of a scope into blocks
    docs, q = _scoped_sides(spark)
    by = lambda most: sorted(map(tuple, index.ranked(together.best_in_scopes(docs, q, 5, "*", 40, most=most), 5, ("query_id", "scope"), 6).collect()))
    got = by(1000)
    assert len(got) > 100 and got == by(0)


def test_no_row_for_every_pair(spark):
    docs, q = _scoped_sides(spark, words=5, n=2000)
    n = together.best_in_scopes(docs, q, 5, "*", 40).groupBy("query_id", "scope").count()
    assert n.count() > 20 and n.agg(F.max("count")).first()[0] < 100


def test_reranking_moves_no_scored_pairs(spark):
    from ledgerloom.plans.search_queries import k_reranked

    plan = k_reranked(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "n_t" not in plan and "label_sets" in plan


def test_keys_meet_once_for_all_ks(spark):
    ranked = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "a", 3), (1, "c", 4), (2, "a", 1), (3, "a", 1)], "query_id int, key string, rank int")
    want = spark.createDataFrame([(1, "b"), (1, "c"), (1, "b"), (2, "z"), (4, "a")], "query_id int, key string")
    got = metrics.at_ks(ranked, want, (1, 2, 4))
    for k in (1, 2, 4):
        one = metrics.macro(metrics.prf(ranked.filter(f"rank <= {k}"), want)).first()
        assert got.filter(f"k = {k}").select(*one.asDict()).first() == one
    # Rows are not multiplied by the ks before they are joined.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("Join")


def test_tables_delivered_twice_stay_where_they_lie(spark):
    from ledgerloom.plans.search_queries import _one_delivery

    t = spark.createDataFrame([("a", "2", "x"), ("a", "1", "y"), ("b", "3", "z"), (None, "4", "n"), ("c", None, "n"), ("d", "5", "v"), ("d", None, "w")], "table_key string, record_id string, grid string")
    one = _one_delivery(t)
    assert sorted(map(tuple, one.collect())) == [("a", "1", "y"), ("b", "3", "z"), ("d", "5", "v")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_common_words_meet_no_names(spark):
    companies = spark.createDataFrame([("AAA", "Công ty Alphax Bee Gamma Deltaz"), ("BBB", "Công ty Betaxy"), ("CCC", "Công ty Gamma Omega")], "ticker string, name string")
    asked = [(1, "Alphax Bee Gamma"), (2, "Bee Gamma"), (3, "Betaxy"), (4, "Gamma Omega và Gamma"), (5, "Alphax x Gamma Deltaz"), (6, "Gamma"), (7, "Bee Gamma Deltaz")]
    got = scope.phrase_matches(spark.createDataFrame(asked, "id int, question string"), companies)
    assert sorted(map(tuple, got.collect())) == [(1, "AAA"), (3, "BBB"), (4, "CCC"), (7, "AAA")]


def _packed_sides(words=30, n=400):
    """Queries and a reader of tables of one scope, packed ten tables at a time; many tables are equal but for their names."""
    import pickle

    import pyarrow as pa

    rng = np.random.default_rng(3)
    text = lambda size: [f"w{x}" for x in rng.integers(0, words, size)]
    kinds = [(text(rng.integers(0, 12)), [text(rng.integers(1, 4)) for _ in range(rng.integers(0, 3))]) for _ in range(60)]
    docs = [{"doc_id": f"d{i}", "scopes": ["*"], "t": kinds[i % 60][0], "label_sets": [list(dict.fromkeys(x)) for x in kinds[i % 60][1]], "bonus": float(i % 2), "related": i % 3 == 0} for i in range(n)]
    asked = [{"query_id": i, "scope": "*", "t": text(5), "asked": i % 4 == 0, "hash": i} for i in range(25)]
    given = [f"w{x}" for x in range(words)], ["*"], [0, 1], [0]
    read = lambda pack, rows, schema: [x for b in pack(iter(pa.Table.from_pylist(rows, pa.schema(schema)).to_batches(max_chunksize=10)), *given) for x in b.column("data").to_pylist()]
    d = read(together.pack_docs, docs, [("doc_id", pa.string()), ("scopes", pa.list_(pa.string())), ("t", pa.list_(pa.string())), ("label_sets", pa.list_(pa.list_(pa.string()))), ("bonus", pa.float64()), ("related", pa.bool_())])
    q = read(together.pack_queries, asked, [("query_id", pa.int64()), ("scope", pa.string()), ("t", pa.list_(pa.string())), ("asked", pa.bool_()), ("hash", pa.int64())])
    return [pickle.loads(x) for x in q], lambda: map(pickle.loads, d)


@pytest.mark.parametrize("near", [0, 3, 40, 1000])
def test_tables_scored_in_shares_equal_all_at_once(monkeypatch, near):
    asked, read = _packed_sides()
    of = lambda: sorted(zip(*together._best(asked, read(), 4, near, 9)))
    whole = of()
    monkeypatch.setattr(together, "AT_ONCE", 25)
    shares = of()
    assert len(whole) > 70 and [x[:2] for x in shares] == [x[:2] for x in whole]
    assert np.allclose([x[2] for x in shares], [x[2] for x in whole], rtol=0, atol=1e-12)


def test_packs_of_a_scope_are_not_held_together():
    import weakref

    asked, read = _packed_sides()
    alive, most = [], 0

    def packs():
        nonlocal most
        for p in read():
            alive.append(weakref.ref(p[3]))  # its words
            most = max(most, sum(x() is not None for x in alive))
            yield p
            del p

    assert len(together._best(asked, packs(), 4, 40, 9)[0]) > 90
    assert len(alive) == 40 and most <= 3
