import random

import numpy as np
import pytest

from ledgerloom.llm import packing
from ledgerloom.llm.packing import Limits, pack

PACKS = "pack_name string, capacity_tokens int"


def loads(window, *sizes):
    n = window.max() + 1 if len(window) else 0
    return [np.bincount(window, s, n) for s in sizes]


def fewest(tokens, cap):
    """Exact smallest number of windows, by search."""
    tokens = sorted(tokens, reverse=True)

    def fits(k):
        room = [cap] * k

        def place(i):
            if i == len(tokens):
                return True
            for r in range(k):
                if room[r] >= tokens[i] and room[r] not in room[:r]:
                    room[r] -= tokens[i]
                    if place(i + 1):
                        return True
                    room[r] += tokens[i]
            return False

        return place(0)

    k = max(1, -(-sum(tokens) // cap))
    while not fits(k):
        k += 1
    return k


def test_limits_hold_and_packing_is_tight():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 257, 3000)
    loss = np.minimum(tokens, rng.integers(0, 257, 3000))
    w = pack(tokens, loss, 256, 6, 200 if loss.max() <= 200 else 256)
    t, lo, n = loads(w, tokens, loss, np.ones(3000))
    assert (w >= 0).all() and t.max() <= 256 and n.max() <= 6 and lo.max() <= 256
    assert len(t) <= 1.05 * tokens.sum() / 256


def test_loss_limit_binds():
    tokens, loss = np.full(40, 10), np.array([10, 0] * 20)
    w = pack(tokens, loss, 100, 100, 30)
    t, lo = loads(w, tokens, loss)
    assert t.max() <= 100 and lo.max() <= 30 and len(t) == 7


def test_near_the_optimum_on_small_cases():
    rng = random.Random(0)
    for _ in range(25):
        tokens = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        a = np.array(tokens)
        got = pack(a, a, 30, 100, 30).max() + 1
        assert got <= fewest(tokens, 30) + 1


@pytest.mark.parametrize("tokens", [[], [0, 0, 0], [5] * 7, [256, 256]])
def test_ties_and_empty(tokens):
    a = np.array(tokens, dtype=np.int64)
    w = pack(a, a, 256, 8, 256)
    assert len(w) == len(a) and (w >= 0).all()


def test_windows(spark):
    rows = [(1, 0, 0, "c"), (2, 100, 10, "c"), (3, 600, 5, "c"), (4, 256, 0, "c"), (4, 256, 0, "c"), (5, 512, 600, "c"), (6, 30, 0, "c"), (7, 156, 0, "c")]
    sizes = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, n_context bigint, piece string")
    packs = spark.createDataFrame([("short", 256), ("none", None), ("bad", 0)], PACKS)
    got = packing.windows(sizes, packs).collect()
    assert {r.pack_name for r in got} == {"short"}
    per = {}
    for r in got:
        per.setdefault((r.doc_id, r.piece), []).append(r.n_tokens)
        assert 0 <= r.n_loss <= r.n_tokens <= 256 and r.start_token == r.piece * 256
    assert sorted(per) == [(1, 0), (2, 0), (3, 0), (3, 1), (3, 2), (4, 0), (5, 0), (5, 1), (6, 0), (7, 0)]
    assert per[3, 2] == [88] and per[4, 0] == [256, 256] and per[1, 0] == [0]
    load = {}
    for r in got:
        load[r.window_id] = load.get(r.window_id, 0) + r.n_tokens
    assert max(load.values()) <= 256 and len(load) <= 8
    assert packing.windows(sizes.limit(0), packs).count() == 0
    with pytest.raises(ValueError):
        packing.windows(sizes, packs.filter("pack_name = 'none'"))


def test_loss_share_splits_long_documents(spark):
    sizes = spark.createDataFrame([(1, 100, 0)], "doc_id bigint, n_tokens bigint, n_context bigint")
    got = packing.windows(sizes, spark.createDataFrame([("p", 100)], PACKS), Limits(loss_share=0.5)).collect()
    assert sorted((r.piece, r.n_tokens, r.n_loss) for r in got) == [(0, 50, 50), (1, 50, 50)]


def test_loss_limit_binds_in_windows(spark):
    """With a limit below the capacity some window reaches it, and none goes beyond."""
    sizes = spark.range(3000).selectExpr("id as doc_id", "id % 90 + 1 as n_tokens", "case when id % 3 = 0 then id % 90 + 1 else 0L end as n_context")
    got = packing.windows(sizes, spark.createDataFrame([("p", 100)], PACKS), Limits(loss_share=0.6)).groupBy("window_id").agg({"n_loss": "sum", "n_tokens": "sum"}).toDF("w", "a", "b").collect()
    most = {max(r.a for r in got), max(r.b for r in got)}
    assert most == {60, 100}


def test_full_pieces_are_windows_of_their_own(spark):
    sizes = spark.createDataFrame([(1, 300, 0), (1, 300, 0), (2, 100, 0)], "doc_id bigint, n_tokens bigint, n_context bigint")
    got = packing.windows(sizes, spark.createDataFrame([("p", 100), ("q", 300)], PACKS)).collect()
    assert len(got) == 10 and len({(r.pack_name, r.window_id) for r in got if r.n_tokens == 100 or r.n_tokens == 300}) == 10


def test_fill(spark):
    sizes = spark.range(500).selectExpr("id as doc_id", "id % 90 + 1 as n_tokens", "0L as n_context")
    packs = spark.createDataFrame([("p", 128)], PACKS)
    f = packing.fill(packing.windows(sizes, packs), packs).first()
    assert f.n_tokens == sum(i % 90 + 1 for i in range(500)) and f.least_windows <= f.n_windows and f.filled > 0.95
