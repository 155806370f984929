"""Sources mixed to target shares by cube-method balanced sampling.

Each document of a source is to be used m times on average; the whole part is certain, the rest is an
inclusion probability. The flight phase moves the probabilities along directions that change neither
the source's token total nor its document total, until at most two units per block are undecided. The
undecided units of many blocks fly together again, level by level; what remains is landed.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import join_checked, settle

#: Units of one block of the flight phase.
BLOCK = 20_000
_EPS = 1e-9


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight phase; at most two lie strictly between 0 and 1. Sums of prob and prob * size stay.

    Two large units trade their chances while a small one takes up the difference in size. So the large
    units are decided first, and what is left to land is about as large as the median unit.
    """
    p = np.where(prob < _EPS, 0.0, np.where(prob > 1 - _EPS, 1.0, prob)).astype(float).tolist()
    s = size.astype(float).tolist()
    undecided = np.flatnonzero((prob >= _EPS) & (prob <= 1 - _EPS))
    # By size, equal sizes in random order.
    order = undecided[np.lexsort((rng.random(len(undecided)), -size[undecided]))].tolist()
    draws = iter(rng.random(len(order) + 1).tolist())
    head, tail = 0, len(order)
    large: list[int] = []
    small: int | None = None
    while True:
        while len(large) < 2 and head < tail:
            large.append(order[head])
            head += 1
        if small is None and head < tail:
            tail -= 1
            small = order[tail]
        if len(large) < 2 or small is None:
            break
        a, b, c = *large, small
        # A direction u with u_a + u_b + u_c = 0 and s_a u_a + s_b u_b + s_c u_c = 0.
        u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
        if max(map(abs, u)) < _EPS:
            u = (1.0, -1.0, 0.0)
        moved = [(i, v) for i, v in zip((a, b, c), u) if v]
        up = min((1 - p[i]) / v if v > 0 else -p[i] / v for i, v in moved)
        down = min(p[i] / v if v > 0 else (p[i] - 1) / v for i, v in moved)
        step = up if next(draws) * (up + down) < down else -down
        for i, v in moved:
            x = p[i] + step * v
            p[i] = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x
        large = [i for i in large if 0 < p[i] < 1]
        small = c if 0 < p[c] < 1 else None
    return np.array(p, dtype=float)


def landing(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide what the flight left open: of the roundings that keep the count, the one nearest in tokens; ties at random."""
    p = flight(prob, size, rng)
    left = np.flatnonzero((p > 0) & (p < 1))
    if len(left) == 0:
        return p
    want_n, want_s = p[left].sum(), (p[left] * size[left]).sum()
    best, cost = None, None
    for bits in range(1 << len(left)):
        z = np.array([bits >> k & 1 for k in range(len(left))], dtype=float)
        c = (max(0.0, abs(z.sum() - want_n) - 1), abs((z * size[left]).sum() - want_s), rng.random())
        if cost is None or c < cost:
            best, cost = z, c
    p[left] = best
    return p


def _fly(last: bool, seed: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", ignore_index=True)
        rng = np.random.default_rng([seed, zlib.crc32(repr(key).encode())])
        f = landing if last else flight
        pdf["prob"] = f(pdf["prob"].to_numpy(), pdf["n_tokens"].to_numpy(float), rng)
        return pdf

    return run


def plan(sizes: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """Per source of targets: its documents and tokens, target_share, max_repeats, and the mean uses of a document.

    Without total_tokens the mixture is as large as the caps allow at the exact shares; a larger total
    leaves capped sources below their share. Sources without tokens can't contribute and don't count.
    targets is a small table; shares and caps that are null or not positive count as 0.
    """
    have = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("source_tokens"))
    t = targets.filter("source is not null and target_share > 0 and max_repeats > 0")
    j = settle(t.join(have, "source", "left").fillna(0, ["n_docs", "source_tokens"]))
    if total_tokens is None:
        got = j.filter("source_tokens > 0").agg(F.min(F.col("max_repeats") * F.col("source_tokens") / F.col("target_share"))).first()[0]
        total_tokens = float(got or 0.0)
    mean = F.when(F.col("source_tokens") > 0, F.least(F.lit(total_tokens) * F.col("target_share") / F.col("source_tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return j.withColumn("mean_uses", mean)


def mixture(sizes: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 7) -> DataFrame:
    """doc_id, source, n_tokens and copies (1 to the source's max_repeats) of every document that is used.

    sizes: doc_id, source, n_tokens. Documents of a null source or one without a target aren't used.
    Blocks are cut by hash within a source, so a source of any size is many tasks. The result is the
    same for the same rows and seed, whatever their order.
    """
    sizes = settle(sizes.select("doc_id", "source", "n_tokens"))
    p = settle(plan(sizes, targets, total_tokens).select("source", "n_docs", "mean_uses"))
    d = join_checked(sizes, p, "source", "inner", 64)  # as many rows as targets
    whole = F.floor(F.col("mean_uses") + _EPS)
    d = d.withColumn("whole", whole.cast("int")).withColumn("prob", F.greatest(F.col("mean_uses") - whole, F.lit(0.0)))
    kind = sizes.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, source string, n_tokens bigint, whole int, prob double, blocks bigint"
    d = d.withColumn("blocks", F.ceil(F.col("n_docs") / F.lit(BLOCK))).select("doc_id", "source", "n_tokens", "whole", "prob", "blocks")
    sure, open_ = d.filter(F.col("prob") <= _EPS), d.filter(F.col("prob") > _EPS)
    parts = [sure]
    most = d.agg(F.max("blocks")).first()[0] or 1
    while True:
        last = most <= 1
        block = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.greatest(F.col("blocks"), F.lit(1)))
        flown = settle(open_.groupBy("source", block.alias("block")).applyInPandas(_fly(last, seed), schema))
        if last:
            parts.append(flown)
            break
        parts.append(flown.filter(F.col("prob").isin(0.0, 1.0)))
        # At most two open units come from each block, so the next level is far smaller.
        open_ = flown.filter(~F.col("prob").isin(0.0, 1.0)).withColumn("blocks", F.ceil(F.col("blocks") * 2 / F.lit(BLOCK)))
        most = -(-most * 2 // BLOCK)
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    copies = (F.col("whole") + F.when(F.col("prob") > 0.5, 1).otherwise(0)).cast("int")
    return out.select("doc_id", "source", "n_tokens", copies.alias("copies")).filter("copies > 0")


def shares(mixed: DataFrame, sizes_plan: DataFrame) -> DataFrame:
    """Per source: documents and tokens in the mixture, its share and the share aimed at."""
    m = mixed.groupBy("source").agg(F.count("*").alias("docs_used"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_used"), F.max("copies").alias("most_copies"))
    j = sizes_plan.select("source", "target_share", "max_repeats", "source_tokens").join(m, "source", "left").fillna(0, ["docs_used", "tokens_used", "most_copies"])
    # As many rows as targets, so one window holds them all.
    j = j.withColumn("total", F.sum("tokens_used").over(Window.partitionBy(F.lit(0))))
    return j.select(
        "source", "target_share", "max_repeats", "source_tokens", "docs_used", "tokens_used", "most_copies", F.coalesce(F.try_divide("tokens_used", "total"), F.lit(0.0)).alias("actual_share")
    )
