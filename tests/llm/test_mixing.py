import numpy as np
import pytest

from ledgerloom.llm import mixing

TARGETS = "source string, target_share double, max_repeats int"


def test_flight_keeps_totals_and_leaves_two():
    rng = np.random.default_rng(1)
    p, s = rng.random(400), rng.integers(1, 500, 400).astype(float)
    q = mixing.flight(p, s, rng)
    open_ = (q > 0) & (q < 1)
    assert open_.sum() <= 2 and abs(q.sum() - p.sum()) < 1e-6 and abs((q * s).sum() - (p * s).sum()) < 1e-3


def test_what_is_left_is_small():
    rng = np.random.default_rng(5)
    s = np.sort(rng.pareto(1.2, 2000) * 100 + 10)
    p = np.full(2000, 0.4)
    z = mixing.landing(p, s, rng)
    assert abs((z * s).sum() - 0.4 * s.sum()) <= 3 * np.median(s) and abs(z.sum() - 800) <= 1


def test_inclusion_probabilities_are_kept():
    p, s = np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3]), np.array([5.0, 1.0, 9.0, 4.0, 2.0, 7.0])
    mean = np.mean([mixing.flight(p, s, np.random.default_rng(i)) for i in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


@pytest.mark.parametrize("p,s", [([], []), ([0.5], [3]), ([0.5, 0.5], [0, 0]), ([1, 0, 1], [1, 2, 3]), ([0.5] * 50, [7] * 50)])
def test_landing_decides_all(p, s):
    z = mixing.landing(np.array(p, dtype=float), np.array(s, dtype=float), np.random.default_rng(0))
    assert set(z.tolist()) <= {0.0, 1.0} and abs(z.sum() - sum(p)) <= 1.0


def sizes(spark, n=3000):
    src = "case when id % 3 = 0 then 'big' when id % 30 = 1 then 'small' when id % 100 = 2 then null when id % 7 = 0 then 'other' else 'mid' end as source"
    return spark.range(n).selectExpr("id as doc_id", src, "(id * 37) % 400 as n_tokens", "'clash' as copies", "1.0 as prob")


def test_shares_and_caps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)  # several levels of blocks
    t = spark.createDataFrame([("big", 0.3, 1), ("small", 0.2, 3), ("mid", 0.5, 2), ("absent", 0.1, 2), (None, 0.1, 2), ("other", None, 2)], TARGETS)
    d = sizes(spark)
    m = mixing.mixture(d, t).collect()
    assert len({r.doc_id for r in m}) == len(m) and {r.source for r in m} == {"big", "small", "mid"}
    cap = {"big": 1, "small": 3, "mid": 2}
    assert all(1 <= r.copies <= cap[r.source] for r in m)
    got = {r.source: r for r in mixing.shares(mixing.mixture(d, t), mixing.plan(d, t)).collect()}
    for source, share in (("big", 0.3), ("small", 0.2), ("mid", 0.5)):
        assert abs(got[source].actual_share - share) < 0.01
    assert got["absent"].tokens_used == 0
    assert sorted(map(tuple, m)) == sorted(map(tuple, mixing.mixture(d.repartition(7), t).collect()))


def test_a_larger_total_meets_the_caps(spark):
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 2)], TARGETS)
    d = sizes(spark)
    m = mixing.mixture(d, t, total_tokens=1e9)
    assert m.filter("source = 'big'").agg({"copies": "max"}).first()[0] == 1
    assert m.filter("source = 'small'").agg({"copies": "min"}).first()[0] == 2


def test_empty_and_repeated(spark):
    t = spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    d = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "a", 0)], "doc_id bigint, source string, n_tokens bigint")
    assert mixing.mixture(d.limit(0), t).count() == 0
    assert mixing.mixture(d, t.limit(0)).count() == 0
    assert mixing.mixture(d, t).count() == 3
