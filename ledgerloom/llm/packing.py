"""Documents packed into windows of a fixed capacity: vector bin packing with the dot-product rule.

A window is limited in tokens, in segments and in loss-bearing tokens at once. Of the items that
still fit, the one goes in whose size vector has the largest dot product with the window's remaining
room, each dimension scaled by its limit. Items of equal size are interchangeable, so a step looks at
one candidate per size, not at every item.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import settle

#: Items in one shard; shards are cut by hash, so a hot source or key can't swell one.
SHARD_ITEMS = 40_000


@dataclass(frozen=True)
class Limits:
    """Limits of a window beside its capacity, as functions of it."""

    tokens_per_segment: int = 32  # a window holds at most capacity / this many segments, at least 8
    loss_share: float = 1.0  # at most this share of the capacity may bear loss

    def segments(self, capacity: int) -> int:
        return max(8, capacity // self.tokens_per_segment)

    def loss(self, capacity: int) -> int:
        return int(capacity * self.loss_share)


def pack(tokens: np.ndarray, loss: np.ndarray, capacity: int, max_segments: int, max_loss: int) -> np.ndarray:
    """Window number of each item; every item must fit into an empty window by itself."""
    n = len(tokens)
    window = np.full(n, -1, dtype=np.int64)
    if n == 0:
        return window
    order = np.lexsort((loss, tokens))
    sizes, starts = np.unique(tokens[order], return_index=True)
    ends = np.append(starts[1:], n)
    # Per size the items are stacked by loss; the top is the one with the largest loss still there.
    stacks = [order[a:b].tolist() for a, b in zip(starts, ends)]
    top = np.array([loss[s[-1]] for s in stacks], dtype=np.float64)
    low = np.array([loss[s[0]] for s in stacks], dtype=np.float64)
    alive = np.array([True] * len(stacks))
    scaled = sizes / capacity
    left, w = n, 0
    rt, rs, rl = capacity, max_segments, max_loss
    while left:
        hi = int(np.searchsorted(sizes, rt, side="right")) if rs > 0 else 0
        ok = alive[:hi] & (low[:hi] <= rl)
        if not ok.any():
            w, rt, rs, rl = w + 1, capacity, max_segments, max_loss
            continue
        fit = np.minimum(top[:hi], rl)
        score = scaled[:hi] * (rt / capacity) + (fit / max_loss) * (rl / max_loss)  # the segment term is the same for all
        score[~ok] = -1.0
        k = int(score.argmax())
        stack = stacks[k]
        at = len(stack) - 1
        while loss[stack[at]] > rl:  # ends: the lowest fits
            at -= 1
        item = stack.pop(at)
        window[item] = w
        rt, rs, rl, left = rt - int(tokens[item]), rs - 1, rl - int(loss[item]), left - 1
        if stack:
            top[k], low[k] = loss[stack[-1]], loss[stack[0]]
        else:
            alive[k] = False
    return window


def windows(sizes: DataFrame, packs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """pack_name, window_id, doc_id, piece, start_token, n_tokens, n_loss: every document once per pack.

    sizes: doc_id, n_tokens, n_context. packs: pack_name, capacity_tokens (a few rows; null or
    non-positive capacities are left out). A document is whole unless it exceeds the capacity (or alone
    exceeds the loss limit); then it is cut into full pieces and a rest. A piece as long as the capacity is a
    window by itself and never reaches Python; the others are packed in hash shards of about SHARD_ITEMS
    items, for all packs in one shuffle. Empty documents are items of size 0. Repeated rows are items each
    for itself; ties among equal items fall by doc_id.
    """
    sizes = settle(sizes.select("doc_id", "n_tokens", "n_context", F.monotonically_increasing_id().alias("row")))
    named = [(r[0], int(r[1])) for r in packs.select("pack_name", "capacity_tokens").collect() if r[1] and r[1] > 0]
    if not named:
        raise ValueError("no pack has a capacity")
    cut = {name: min(cap, max(1, limits.loss(cap))) for name, cap in named}
    pieces = lambda name: F.greatest(F.ceil(F.col("n_tokens") / F.lit(cut[name])), F.lit(1)).cast("int")
    # Items that are packed: all pieces, or where full pieces are windows one rest at most per document.
    items = sizes.agg(*[F.sum(pieces(n) if cut[n] < c else F.lit(1)).alias(f"i{k}") for k, (n, c) in enumerate(named)]).first()
    shards = [max(1, -(-(items[k] or 0) // SHARD_ITEMS)) for k in range(len(named))]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("bigint").alias("cap"), F.lit(cut[n]).cast("bigint").alias("cut"), F.lit(s).alias("shards"), pieces(n).alias("pieces")) for (n, c), s in zip(named, shards)]))
    p = sizes.withColumn("p", each).select("doc_id", "row", "n_tokens", "n_context", "p.*")
    p = p.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    start = F.col("piece").cast("bigint") * F.col("cut")
    size = F.greatest(F.least(F.col("n_tokens") - start, F.col("cut")), F.lit(0).cast("bigint"))
    loss = size - F.least(size, F.greatest(F.col("n_context") - start, F.lit(0)))
    p = p.select("pack_name", "doc_id", "row", "piece", "cap", "shards", start.alias("start_token"), size.alias("n_tokens"), loss.alias("n_loss"))
    cols = ["pack_name", "window_id", "doc_id", "piece", "start_token", "n_tokens", "n_loss"]
    full = p.filter("n_tokens = cap").withColumn("window_id", F.concat(F.lit("full-"), F.col("row").cast("string"), F.lit("-"), F.col("piece").cast("string"))).select(*cols)
    rest = p.filter("n_tokens < cap").withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.col("shards")).cast("int"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cap = dict(named)[key[0]]
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable", ignore_index=True)
        w = pack(pdf["n_tokens"].to_numpy(np.int64), pdf["n_loss"].to_numpy(np.int64), cap, limits.segments(cap), limits.loss(cap))
        pdf["window_id"] = [f"{key[1]}-{x}" for x in w]
        return pdf[cols]

    kind = sizes.schema["doc_id"].dataType.simpleString()
    schema = f"pack_name string, window_id string, doc_id {kind}, piece int, start_token bigint, n_tokens bigint, n_loss bigint"
    packed = rest.select("pack_name", "shard", "doc_id", "piece", "start_token", "n_tokens", "n_loss").groupBy("pack_name", "shard").applyInPandas(run, schema)
    return full.unionByName(packed)


def fill(packed: DataFrame, packs: DataFrame) -> DataFrame:
    """Per pack: windows, documents' tokens, the share of the room that is filled, the fewest windows possible, and the most segments and loss-bearing tokens in one window."""
    w = packed.groupBy("pack_name", "window_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("s"), F.sum("n_loss").alias("l"))
    w = w.groupBy("pack_name").agg(F.count("*").alias("n_windows"), F.sum("t").alias("n_tokens"), F.max("s").alias("most_segments"), F.max("l").alias("most_loss"))
    return w.join(packs, "pack_name").select(
        "pack_name", "capacity_tokens", "n_windows", "n_tokens", "most_segments", "most_loss",
        F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_windows"),
        (F.col("n_tokens") / (F.col("n_windows") * F.col("capacity_tokens"))).alias("filled"),
    )
