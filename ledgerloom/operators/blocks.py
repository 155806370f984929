"""Exact top k of a block of queries against all documents, without moving documents or scored pairs.

The block (its terms with weights, or its vectors) goes to every task; each task scores the documents it reads as small
matrices and keeps the k best of every query, so only tasks x queries x k rows are shuffled. Blocks are of checked size;
more queries are searched in several blocks by hash, each reading the documents once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Numbers in one matrix of scores.
MATRIX = 4_000_000


class Best:
    """The k best (query, document) pairs seen so far; ties by the document's text form, scores rounded first."""

    def __init__(self, k: int, digits: int):
        self.k, self.digits = k, digits
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.doc = np.empty(0, dtype=object)

    def add(self, scores: np.ndarray, queries: np.ndarray, docs: np.ndarray, floor: float = -np.inf) -> None:
        """scores: queries x documents; pairs not above floor don't count."""
        scores = np.round(scores, self.digits)
        n = scores.shape[1]
        if n > self.k:
            least = np.partition(scores, n - self.k, axis=1)[:, n - self.k, None]
            keep = (scores >= least) & (scores > floor)
        else:
            keep = scores > floor
        q, d = np.nonzero(keep)
        self.query = np.concatenate([self.query, queries[q]])
        self.score = np.concatenate([self.score, scores[q, d]])
        self.doc = np.concatenate([self.doc, docs[d]])
        if len(self.query) > MATRIX // 4:
            self.cut()

    def cut(self) -> None:
        order = np.lexsort((np.array(list(map(str, self.doc)), dtype=str), -self.score, self.query))
        q = self.query[order]
        first = np.r_[True, q[1:] != q[:-1]]
        place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        order = order[place < self.k]
        self.query, self.score, self.doc = self.query[order], self.score[order], self.doc[order]

    def table(self, query_ids: np.ndarray, doc_type: pa.DataType, query_type: pa.DataType) -> pa.RecordBatch:
        if len(self.query):
            self.cut()
        return pa.RecordBatch.from_arrays([pa.array(query_ids[self.query].tolist(), query_type), pa.array(self.doc.tolist(), doc_type), pa.array(self.score, pa.float64())], ["query_id", "doc_id", "score"])


def unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    if not (norm > 0).all():
        raise ValueError("a vector without direction")
    return m / norm


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of doubles; nulls and rows of another length are a ValueError."""
    if column.null_count:
        raise ValueError("a vector without direction")
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n and len(flat) % n or n and (np.diff(column.offsets.to_numpy()) != len(flat) // n).any():
        raise ValueError("vectors of different lengths")
    return flat.reshape(n, -1) if n else np.empty((0, 1))


def vector_search(queries: dict, ids: np.ndarray, k: int, digits: int, types: tuple[pa.DataType, pa.DataType]):
    """A mapInArrow function over (doc_id, vector, [scope]). queries: scope (None for all) to (positions, unit vectors)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, digits)
        for b in batches:
            if b.num_rows == 0:
                continue
            v = unit_rows(matrix(b.column("vector")))
            docs = np.array(b.column("doc_id").to_pylist(), dtype=object)
            scopes = np.array(b.column("scope").to_pylist(), dtype=object) if "scope" in b.schema.names else None
            for scope, (at, q) in queries.items():
                mine = np.arange(len(docs)) if scopes is None else np.flatnonzero(scopes == scope)
                step = max(1, MATRIX // max(len(at), 1))
                for a in range(0, len(mine), step):
                    part = mine[a : a + step]
                    best.add(q @ v[part].T, at, docs[part])
        yield best.table(ids, *types)

    return run


def term_search(weights: dict, lengths: dict, ids: np.ndarray, k: int, digits: int, k1: float, b: float, types: tuple[pa.DataType, pa.DataType]):
    """A mapInArrow function over (scope, doc_id, dl, term) with one row per asked token, a document's rows together.

    weights: scope to (number of queries, their positions, {term: (local query numbers, qf * idf)}). lengths: scope to mean length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, digits)
        rest: pa.Table | None = None

        def score(t: pa.Table) -> None:
            docs, scopes = np.array(t.column("doc_id").to_pylist(), dtype=object), np.array(t.column("scope").to_pylist(), dtype=object)
            term, dl = t.column("term").to_numpy(), t.column("dl").to_numpy()
            new = np.r_[True, (docs[1:] != docs[:-1]) | (scopes[1:] != scopes[:-1])]
            row = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            for scope in dict.fromkeys(scopes[starts].tolist()):
                n, at, by_term = weights[scope]
                mine = np.flatnonzero(scopes[starts] == scope)
                step = max(1, MATRIX // n)
                place = np.full(len(starts), -1)
                for a in range(0, len(mine), step):
                    part = mine[a : a + step]
                    place[part] = np.arange(len(part))
                    inside = place[row] >= 0
                    key, f = np.unique(term[inside].astype(np.int64) * len(part) + place[row[inside]], return_counts=True)
                    place[part] = -1
                    of, d = key // len(part), key % len(part)
                    tf = f * (k1 + 1.0) / (f + k1 * (1.0 - b + b * dl[starts[part]][d] / lengths[scope]))
                    s = np.zeros((n, len(part)))
                    cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                    for lo, hi in zip(cuts, np.r_[cuts[1:], len(of)]):
                        q, w = by_term[int(of[lo])]
                        s[np.ix_(q, d[lo:hi])] += np.outer(w, tf[lo:hi])
                    best.add(s, at, docs[starts[part]], 0.0)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            # The last document may go on in the next batch.
            doc, scope, cut = t.column("doc_id"), t.column("scope"), t.num_rows - 1
            last = (doc[cut].as_py(), scope[cut].as_py())
            while cut > 0 and (doc[cut - 1].as_py(), scope[cut - 1].as_py()) == last:
                cut -= 1
            rest = t.slice(cut)
            if cut:
                score(t.slice(0, cut).combine_chunks())
        if rest is not None:
            score(rest.combine_chunks())
        yield best.table(ids, *types)

    return run
