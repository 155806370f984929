"""Reading level of documents from interpolated n-gram models and isotonic regression.

One interpolated word model per graded level is trained on labelled documents. Under each model every word of a
document has a surprisal; the distribution of these surprisals over the sentences of the whole document gives its score:
in each sentence the least surprised models tell how demanding it reads, and the score is the weighted mean over all of
them. Isotonic regression on held-out scores of labelled documents maps the score monotonically to the grades. Coarser
statistics of the same distributions (mean under one model, difference of two models' means, deviation, tail) order
documents worse; the README has the figures.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.text import fold_text
from ..session import settle

#: At most about this many labelled documents are used for training.
MAX_LABELLED = 20_000
LEVELS = 4
UNI, BI = 1 << 16, 1 << 18
#: Words of one piece of a run without sentence marks, and the weights of the two-word, one-word and uniform model.
WINDOW = 16
WEIGHTS = (0.6, 0.3, 0.1)
_NOT_WORD = re.compile(r"[^\w]+|_")
_DIGITS = re.compile(r"\d+")
_ENDS = re.compile(r"[.!?…。][)\"'»”]*$")
_KNOWN_LIMIT = 500_000


def word_code(raw: str) -> int:
    """Twice the hash bucket of a word without accents, case and punctuation, numbers alike; one more if it ends a sentence; -1 for none."""
    w = _DIGITS.sub("0", _NOT_WORD.sub("", fold_text(raw)))
    return zlib.crc32(w.encode()) % UNI * 2 + bool(_ENDS.search(raw)) if w else -1


class Words:
    """Texts to lists of word codes; spellings once met are remembered."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, raw = self.known, text.split()
        out = list(map(known.get, raw))
        if None in out:
            if len(known) > _KNOWN_LIMIT:
                known.clear()
            for i, b in enumerate(out):
                if b is None:
                    out[i] = known[raw[i]] = word_code(raw[i])
        return [b for b in out if b >= 0] if -1 in out else out


def pair_bucket(ids: np.ndarray) -> np.ndarray:
    """Buckets of the pairs (word before, word), one less than there are words."""
    return (ids[:-1] * 1_000_003 + ids[1:] * 7_919) % BI


@dataclass
class Model:
    """Per level: probability of a word, and of a word after another."""

    uni: np.ndarray
    bi: np.ndarray

    @staticmethod
    def of(uni: np.ndarray, bi: np.ndarray, before: np.ndarray) -> "Model":
        """uni, bi and before: weighted counts by level and bucket; before[k] counts the pair's first word."""
        total = np.maximum(uni.sum(axis=1, keepdims=True), 1.0)
        return Model((uni / total).astype(np.float32), np.divide(bi, before, out=np.zeros_like(bi), where=before > 0).clip(0, 1).astype(np.float32))

    def surprisal(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Levels x words. first marks words that begin a document and have none before them."""
        p = WEIGHTS[1] * self.uni[:, ids] + np.float32(WEIGHTS[2] / UNI)
        after = WEIGHTS[0] * self.bi[:, pair_bucket(ids)]
        after[:, first[1:]] = 0
        p[:, 1:] += after
        return -np.log(p)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Weighted n-gram counts of labelled documents, added up within the task."""
    words, acc = Words(), {}
    for pdf in batches:
        for text, fold, levels in zip(pdf["text"], pdf["fold"], pdf["levels"]):
            ids = np.array(words(text), dtype=np.int64) >> 1
            if len(ids) == 0:
                continue
            said = sum(x["n"] for x in levels)
            for x in levels:
                u, b = acc.setdefault((fold, x["level"]), (np.zeros(UNI), np.zeros(BI)))
                wt = x["n"] / said
                u += np.bincount(ids, minlength=UNI) * wt
                if len(ids) > 1:
                    b += np.bincount(pair_bucket(ids), minlength=BI) * wt
    for (fold, level), (u, b) in acc.items():
        for kind, a in (("u", u), ("b", b)):
            at = np.flatnonzero(a)
            yield pd.DataFrame({"fold": fold, "level": level, "kind": kind, "bucket": at, "n": a[at]})


def _firsts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each pair bucket that occurs: which word comes first in it (pairs that share a bucket share the smallest)."""
    words, first = Words(), np.full(BI, UNI, dtype=np.int64)
    for pdf in batches:
        for text in pdf["text"]:
            ids = np.array(words(text), dtype=np.int64) >> 1
            if len(ids) > 1:
                np.minimum.at(first, pair_bucket(ids), ids[:-1])
    at = np.flatnonzero(first < UNI)
    yield pd.DataFrame({"bucket": at, "word": first[at]})


#: Sentences beyond LONGEST words are taken for runs whose marks are lost and cut evenly. A sentence of n
#: words weighs n to this power: between one vote a sentence (0) and one a word (1).
LONGEST, SENTENCE_POWER = 90, 0.6


def sentences(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of sentences, cut after end marks and at document starts; long runs are cut evenly."""
    at = first.copy()
    at[1:] |= end[:-1]
    cut = np.flatnonzero(at)
    length = np.diff(np.append(cut, len(first)))
    pieces = np.where(length > LONGEST, length // WINDOW, 1)
    owner = np.repeat(np.arange(len(cut)), pieces)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cut = cut[owner] + k * length[owner] // pieces[owner]
    return cut, np.diff(np.append(cut, len(first)))


def _scores(model: Model, batches: Iterator[pd.DataFrame], keep: list[str], spread: bool) -> Iterator[pd.DataFrame]:
    words = Words()
    grades = np.arange(1, LEVELS + 1)
    for pdf in batches:
        texts = pdf.pop("text").tolist()
        score = np.ones(len(texts))
        stats = np.full((len(texts), 4), np.nan)
        lo = 0
        while lo < len(texts):
            # A slice of whole documents of bounded size together.
            part, sizes, hi, chars = [], [], lo, 0
            while hi < len(texts) and (hi == lo or chars + len(texts[hi] or "") < 600_000):
                ids = words(texts[hi])
                chars += len(texts[hi] or "")
                part += ids
                sizes.append(len(ids))
                hi += 1
            n = np.array(sizes)
            if part:
                starts = np.concatenate([[0], np.cumsum(n)[:-1]])
                codes = np.array(part, dtype=np.int64)
                ids = codes >> 1
                first = np.zeros(len(ids), dtype=bool)
                first[starts[n > 0]] = True
                s = model.surprisal(ids, first)
                cut, length = sentences(first, (codes & 1).astype(bool))
                doc = np.repeat(np.arange(len(n)), n)[cut]
                per = np.bincount(doc, minlength=len(n))
                w = np.add.reduceat(s, cut, axis=1)
                like = np.exp(-0.5 * (w - w.min(axis=0)))
                like /= like.sum(axis=0)
                has = n > 0
                weight = length**SENTENCE_POWER
                sums, total = np.bincount(doc, grades @ like * weight, len(n)), np.bincount(doc, weight, len(n))
                score[lo:hi][has] = sums[has] / total[has]
                if spread:
                    best = w.min(axis=0) / length
                    mean = np.bincount(doc, best * length, len(n))[has] / n[has]
                    sq = np.bincount(doc, best * best * length, len(n))[has] / n[has]
                    stats[lo:hi][has] = np.column_stack([mean, np.sqrt(np.maximum(sq - mean * mean, 0)), per[has], n[has]])
            lo = hi
        out = pdf[keep].copy()
        out["score"] = score
        if spread:
            out["surprisal"], out["surprisal_sd"] = stats[:, 0], stats[:, 1]
            out["n_words"] = np.nan_to_num(stats[:, 3]).astype(np.int64)
        yield out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing fit: knots and their values; equal x are one point."""
    knots, at = np.unique(x, return_inverse=True)
    weight = np.bincount(at).astype(float)
    value = np.bincount(at, y) / weight
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, c2 = blocks.pop()
            v1, w1, c1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, c1 + c2])
    return knots, np.concatenate([[v] * int(c) for v, _, c in blocks]) if blocks else value


def graded(score: np.ndarray, knots: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Levels of scores: the isotonic value, linear between knots and flat beyond them, rounded."""
    if len(knots) == 0:
        return np.clip(np.floor(score + 0.5), 1, LEVELS).astype(int)
    return np.clip(np.floor(np.interp(score, knots, values) + 0.5), 1, LEVELS).astype(int)


def fit(docs: DataFrame, samples: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[Model, np.ndarray, np.ndarray]:
    """The models of all levels and the isotonic map, from at most about max_labelled labelled documents.

    If there are more, those with the smallest hashes are taken. Only n-gram counts (at most a fixed
    number of buckets) and one score per labelled document reach the driver. Labels outside the scale don't count.
    """
    spark = docs.sparkSession
    # Labels are counted, so a document has one entry per level however often it was labelled.
    lab = samples.filter(F.col("doc_id").isNotNull() & F.col("level").between(1, LEVELS)).groupBy("doc_id", "level").agg(F.count("*").alias("n"))
    lab = settle(lab.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(F.col("level").cast("int").alias("level"), "n"))).alias("levels")))
    n = lab.count()
    if n > max_labelled:
        lab = lab.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * max_labelled / n))
    train = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    train = settle(train)  # bounded by max_labelled
    counts = train.mapInPandas(_counts, "fold int, level int, kind string, bucket int, n double").groupBy("fold", "level", "kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    firsts = train.mapInPandas(_firsts, "bucket int, word int").groupBy("bucket").agg(F.min("word").alias("word")).toPandas()
    uni, bi = np.zeros((2, LEVELS, UNI)), np.zeros((2, LEVELS, BI))
    for kind, a in (("u", uni), ("b", bi)):
        c = counts[counts["kind"] == kind]
        a[c["fold"], c["level"] - 1, c["bucket"]] = c["n"]
    word = np.zeros(BI, dtype=np.int64)
    word[firsts["bucket"]] = firsts["word"]

    def model(u: np.ndarray, b: np.ndarray) -> Model:
        before = u[:, word]
        before[:, b.sum(axis=0) == 0] = 0
        return Model.of(u, b, before)

    held = [spark.sparkContext.broadcast(model(uni[1 - f], bi[1 - f])) for f in (0, 1)]

    def cross(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["y"] = [sum(x["level"] * x["n"] for x in v) / sum(x["n"] for x in v) for v in pdf["levels"]]
            for f in (0, 1):
                part = pdf[pdf["fold"] == f][["text", "y"]].reset_index(drop=True)
                yield from _scores(held[f].value, iter([part]), ["y"], False)

    seen = train.mapInPandas(cross, "y double, score double").toPandas()
    knots, values = isotonic(np.round(seen["score"].to_numpy(), 3), seen["y"].to_numpy())
    return model(uni.sum(axis=0), bi.sum(axis=0)), knots, values


def reading_levels(docs: DataFrame, samples: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, level (1 to 4), score, surprisal (mean of the best model per word), surprisal_sd over sentences, n_words.

    Whole texts count. A null or empty text, or one without words, has level 1, score 1 and no surprisal.
    Repeated documents get a row each. Without any labelled document the model knows nothing: scores are
    the middle of the scale and only rounded. Other columns are ignored.
    """
    model, knots, values = fit(docs, samples, max_labelled)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # UNI and BI fix its size, about 5 MB

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in _scores(sent.value, batches, ["doc_id"], True):
            out["level"] = np.where(out["n_words"] > 0, graded(np.round(out["score"].to_numpy(), 3), knots, values), 1).astype(np.int32)
            yield out[["doc_id", "level", "score", "surprisal", "surprisal_sd", "n_words"]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, level int, score double, surprisal double, surprisal_sd double, n_words bigint")
