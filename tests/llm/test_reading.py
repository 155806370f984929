import numpy as np

from ledgerloom.llm import queries, reading, tokens

SF = "/root/testdata/sf0.01"


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        x, y = rng.integers(0, 6, 12).astype(float), rng.normal(size=12)
        knots, fit = reading.isotonic(x, y)
        assert (np.diff(fit) >= -1e-12).all() and list(knots) == sorted(set(x))
        # Min-max formula of the isotonic fit.
        w = np.array([(x == k).sum() for k in knots], dtype=float)
        m = np.array([y[x == k].mean() for k in knots])
        avg = lambda a, b: (w[a : b + 1] * m[a : b + 1]).sum() / w[a : b + 1].sum()
        want = [max(min(avg(a, b) for b in range(i, len(m))) for a in range(i + 1)) for i in range(len(m))]
        assert np.allclose(fit, want)


def test_words_ignore_dress():
    w = reading.Words()
    assert w("Lợi nhuận, tăng 15%!") == w("LOI  NHUAN tang 2.") and w("") == [] and w(None) == [] and w("... !") == []


def test_held_out_accuracy(spark):
    """Trained on one half of the labelled documents, right on most of the agreed labels of the other."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/level_samples.parquet")
    docs10, lab10 = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "level_samples"))
    agreed = lab10.groupBy("doc_id").agg({"level": "min", "*": "count"}).toDF("doc_id", "level", "n")
    hi = lab10.groupBy("doc_id").agg({"level": "max"}).toDF("doc_id", "hi")
    agreed = agreed.join(hi, "doc_id").filter("level = hi")
    train, test = lab10.filter("doc_id % 2 = 0"), agreed.filter("doc_id % 2 = 1")
    got = reading.reading_levels(docs10, train).join(test.select("doc_id", test.level.alias("truth")), "doc_id")
    right, n = got.filter("level = truth").count(), got.count()
    assert n > 100 and right >= 0.95 * n
    assert reading.reading_levels(docs, labels).filter("level not between 1 and 4").count() == 0


def test_null_empty_and_long_texts(spark):
    rows = [(1, None, "x", 9), (2, "", "x", 9), (3, "!!! ...", "x", 9), (4, "từ " * 120_000, "x", 9), (4, "một hai", "x", 9), (5, "một", "x", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, level int")
    none = spark.createDataFrame([], "doc_id bigint, annotator string, level int")
    some = spark.createDataFrame([(4, "a", 2), (4, "b", None), (9, "a", 1), (None, "a", 1), (5, "a", 7)], "doc_id bigint, annotator string, level int")
    for labels in (none, some):
        got = reading.reading_levels(docs, labels).collect()
        assert len(got) == 6 and all(1 <= r.level <= 4 for r in got)
        assert all(r.level == 1 and r.n_words == 0 for r in got if r.doc_id in (1, 2, 3))
    assert reading.reading_levels(docs.limit(0), some).count() == 0


def test_bound_on_labelled_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/level_samples.parquet")
    assert reading.reading_levels(docs, labels, max_labelled=20).count() == docs.count()


def test_tokens_of_long_texts_come_in_slices(monkeypatch):
    import random

    enc, rng = tokens.encoder(tokens.VOCABULARY), random.Random(1)
    texts = ["Doanh thu thuần hợp nhất năm 2021.\n" * 20_000]
    texts += ["".join(rng.choice(["năm ", "2021", " ", "  ", "\n", "\n\n", "…", "it's", "(1.234)", "\t", "đồng"]) for _ in range(4000)) for _ in range(20)]
    monkeypatch.setattr(tokens, "SLICE", 500)
    for text in texts:
        assert tokens.count_tokens(text) == len(enc.encode_ordinary(text))
    monkeypatch.setattr(tokens, "SLICE", 200_000)
    assert tokens.count_tokens(None) == tokens.count_tokens("") == 0 and tokens.count_tokens("x" * 450_000) > 0
    assert enc.decode(enc.encode_ordinary("Cộng: 1.234 đồng\n\n")) == "Cộng: 1.234 đồng\n\n"


def test_labels_are_counted_not_cut(spark):
    """A document labelled forty times keeps all its labels, those off the scale apart."""
    docs = spark.createDataFrame([(1, "một hai ba"), (2, "bốn năm sáu")], "doc_id bigint, text string")
    rows = [(1, "a", 1)] * 3 + [(1, "b", 4)] * 37 + [(2, "a", 9)]
    _, knots, values = reading.fit(docs, spark.createDataFrame(rows, "doc_id bigint, annotator string, level int"))
    assert len(knots) == 1 and abs(values[0] - (3 + 37 * 4) / 40) < 1e-9


def test_every_query_runs(spark):
    for name, q in queries.QUERIES.items():
        assert q(spark, "/root/testdata/sf0.001").count() > 0, name
