"""Exact best tables of each query inside its scope by BM25 and rerank, without a row for every pair of query and table.

The tables and the queries of a scope are packed as numbers and meet in one task, which counts the statistics of the scope,
scores all its pairs in memory and gives only the best of each query. A scope of many pairs is cut into blocks of queries,
each beside all tables of the scope, which are kept in a few bytes a word and scored some at a time. Scopes too large for a task's memory are scored by shuffle joins.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import join_checked, settle
from . import index as I, rank as R

#: Tables of one scope that a task takes; distinct words of all queries, in bytes, and scopes that go to every task.
MOST_TOGETHER, WORD_BYTES, MOST_SCOPES = 1_000_000, 32 << 20, 200_000
#: Pairs from which a scope's queries are cut into blocks; bytes of packed tables in a task's share; bytes of dense rows.
PAIRS, SHARE_BYTES, DENSE_BYTES = 50_000_000, 64 << 20, 128 << 20
#: Tables that are scored at a time, with the rest of the pack that fills the number.
AT_ONCE = 1 << 16
_PACKS = "part int, key int, kind int, data binary"


def best_in_scopes(docs: DataFrame, queries: DataFrame, k: int, everywhere: str | None = None, near: int = 0, digits: int = 9, most: int = MOST_TOGETHER) -> DataFrame:
    """(query_id, scope, doc_id, score): at least the k best of each query and scope, those that tie with the k-th included.

    score is BM25 in the scope with `rank.reranked`. In the scope `everywhere` only the `near` best by BM25 are reranked. docs:
    doc_id, scopes (all that it stands in), t (its tokens), label_sets, section, identity; queries: query_id, scope, text.
    """
    asked = F.lower(F.coalesce("text", F.lit(""))).contains(R.RELATED)
    q = settle(queries.select("query_id", "scope", "text", I.tokens(F.col("text"), I.STOP_WORDS).alias("t"), asked.alias("asked")))
    n_queries = q.groupBy("scope").agg(F.count("*").alias("n"))
    n_docs = join_checked(docs.select(F.explode("scopes").alias("scope")), n_queries.select("scope"), "scope", "left_semi", 64).groupBy("scope").agg(F.count("*").alias("n_docs"))
    # One row more than fits shows that it doesn't.
    sizes = n_queries.join(n_docs, "scope").limit(MOST_SCOPES + 1).collect()
    words = q.select(F.explode("t").alias("word")).distinct()
    n_words, width = words.agg(F.count("*"), F.max(F.octet_length("word"))).first()
    if len(sizes) > MOST_SCOPES or max((r.n_docs for r in sizes), default=0) > most or n_words * ((width or 0) + 8) > WORD_BYTES:
        return by_joins(docs, q, everywhere, near, digits)
    spark = docs.sparkSession
    cores = spark.sparkContext.defaultParallelism
    plan = sorted(((r.scope, r.n, r.n_docs, min(cores, -(-r.n * r.n_docs // PAIRS))) for r in sizes), key=lambda x: -x[1] * x[2] / x[3])
    n_parts = max(2 * cores, sum(d * b for _, _, d, b in plan) * 600 // SHARE_BYTES)
    # The heaviest first, each to the part with the least so far.
    load, parts, first = [(0.0, p) for p in range(n_parts)], [], [0]
    for _, n, d, b in plan:
        for _ in range(b):
            least, p = heapq.heappop(load)
            parts.append(p)
            heapq.heappush(load, (least + n * d / b + 20 * (n / b + d), p))
        first.append(len(parts))
    scopes = [x[0] for x in plan]
    sent = spark.sparkContext.broadcast((words.toArrow().column(0).combine_chunks().to_pylist(), scopes, first, parts))
    kinds = {f.name: f.dataType for f in docs.schema} | {f.name: f.dataType for f in q.schema}
    out = StructType([StructField("query_id", kinds["query_id"]), StructField("scope", StringType()), StructField("doc_id", kinds["doc_id"]), StructField("score", DoubleType())])
    schema = to_arrow_schema(out)
    far = scopes.index(everywhere) if everywhere in scopes else -1

    def packed_docs(batches, sent=sent):
        return pack_docs(batches, *sent.value)

    def packed_queries(batches, sent=sent):
        return pack_queries(batches, *sent.value)

    def run(batches, sent=sent):
        return scored(batches, sent.value[1], sent.value[2], schema, k, far, near, digits)

    bonus = F.when(F.col("section").isin(*R.PRIMARY), R.SECTION_BONUS).otherwise(0.0)
    related = F.coalesce((F.col("section") == "notes") & F.lower(F.coalesce("identity", F.lit(""))).contains(R.RELATED), F.lit(False))
    d = docs.select("doc_id", "scopes", "t", "label_sets", bonus.alias("bonus"), related.alias("related")).mapInArrow(packed_docs, _PACKS)
    a = q.select("query_id", F.col("scope").cast("string").alias("scope"), "t", "asked", F.pmod(F.xxhash64("query_id"), F.lit(1 << 30)).alias("hash")).mapInArrow(packed_queries, _PACKS)
    met = a.unionByName(d).repartitionById(n_parts, F.col("part")).sortWithinPartitions("key", "kind")
    return met.mapInArrow(run, out)


def by_joins(docs: DataFrame, queries: DataFrame, everywhere: str | None, near: int, digits: int) -> DataFrame:
    """What `best_in_scopes` scores, all of it, by shuffle joins."""
    q = queries.select("query_id", "scope", "text")
    d = settle(join_checked(docs.select(F.explode("scopes").alias("scope"), "doc_id", "t"), q.select("scope").distinct(), "scope", "left_semi", 64))
    all_, own = F.col("scope") == F.lit(everywhere), ~F.col("scope").eqNullSafe(F.lit(everywhere))
    found = I.bm25(d.filter(own), q.filter(own))
    if everywhere is not None:
        found = found.unionByName(I.top_documents(d.filter(all_), q.filter(all_), near, digits=digits).drop("rank"))
    asked = q.select("query_id", "scope", F.coalesce("text", F.lit("")).alias("question"), R.token_set(F.col("text")).alias("q_set"))
    return R.reranked(found.join(asked, ["query_id", "scope"]).join(docs.select("doc_id", "label_sets", "section", "identity"), "doc_id")).select("query_id", "scope", "doc_id", "score")


def _lists(c: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """Elements and lengths of a list column; one without rows may come without offsets."""
    if not len(c):
        return c.values.slice(0, 0), np.zeros(0, dtype=np.int64)
    o = c.offsets.to_numpy()
    return c.values.slice(o[0], o[-1] - o[0]), np.diff(o)


def _numbers(values: pa.Array, known: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(values, value_set=known), -1).to_numpy(zero_copy_only=False)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of the runs that begin at starts."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _starts(sorted_rows: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_rows, np.arange(n + 1))


def _counted(t: pa.ListArray, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known words of each row once, with their counts: starts, numbers, counts."""
    values, lengths = _lists(t)
    ids, row = _numbers(values, words).astype(np.int64), np.repeat(np.arange(len(t)), lengths)
    width = max(len(words), 1)
    u, f = np.unique((row * width + ids)[ids >= 0], return_counts=True)
    return _starts(u // width, len(t)), (u % width).astype(np.int32), f.astype(np.int32)


def _rows(packs: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    names, types = ["part", "key", "kind", "data"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    held, n = [], 0
    for x in packs:
        held.append(x)
        n += len(x[3])
        if n > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _groups(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each key that isn't negative."""
    order = np.argsort(keys, kind="stable")
    order = order[np.searchsorted(keys[order], 0) :]
    cuts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0]) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(keys[order[a]]), order[a:b]


def pack_docs(batches: Iterator[pa.RecordBatch], words: list, scopes: list, first: list, parts: list) -> Iterator[pa.RecordBatch]:
    known, of_scope = pa.array(words, pa.string()), pa.array(scopes, pa.string())

    def packs():
        for b in batches:
            n = b.num_rows
            ids = np.array(b.column("doc_id").to_pylist(), dtype=object)
            starts, term, f = _counted(b.column("t"), known)
            dl = _lists(b.column("t"))[1]
            bonus, related = (b.column(c).to_numpy(zero_copy_only=False) for c in ("bonus", "related"))
            # Labels with an asked word, each number once: its length and its asked words.
            labels, n_labels = _lists(b.column("label_sets"))
            values, width = _lists(labels)
            w = _numbers(values, known)
            of = np.repeat(np.arange(len(width)), width)[w >= 0]
            w, of = w[w >= 0].astype(np.int32), _starts(of, len(width))
            seen: dict = {}
            number = np.full(len(width), -1)
            for i in np.flatnonzero(np.diff(of)):
                number[i] = seen.setdefault((int(width[i]), w[of[i] : of[i + 1]].tobytes()), len(seen))
            label, row = number[number >= 0], np.repeat(np.arange(n), n_labels)[number >= 0]
            l_starts, table = _starts(row, n), list(seen)
            names, counts = _lists(b.column("scopes"))
            row = np.repeat(np.arange(n), counts)
            for s, at in _groups(_numbers(names, of_scope)):
                r = row[at]
                n_terms, n_own = starts[r + 1] - starts[r], l_starts[r + 1] - l_starts[r]
                places = _spread(starts[r], n_terms)
                used, own = np.unique(label[_spread(l_starts[r], n_own)], return_inverse=True)
                data = pickle.dumps((ids[r].tolist(), dl[r], n_terms, term[places], f[places], n_own, own.astype(np.int32), [table[i] for i in used], bonus[r], related[r]), 5)
                for key in range(first[s], first[s + 1]):
                    yield parts[key], key, 1, data

    return _rows(packs())


def pack_queries(batches: Iterator[pa.RecordBatch], words: list, scopes: list, first: list, parts: list) -> Iterator[pa.RecordBatch]:
    known, of_scope, first = pa.array(words, pa.string()), pa.array(scopes, pa.string()), np.array(first)

    def packs():
        for b in batches:
            ids = np.array(b.column("query_id").to_pylist(), dtype=object)
            starts, term, f = _counted(b.column("t"), known)
            asked = b.column("asked").to_numpy(zero_copy_only=False)
            s = _numbers(b.column("scope"), of_scope)
            block = b.column("hash").to_numpy() % np.maximum(first[s + 1] - first[s], 1)
            for key, r in _groups(np.where(s >= 0, first[s] + block, -1)):
                n_terms = starts[r + 1] - starts[r]
                places = _spread(starts[r], n_terms)
                yield parts[key], key, 0, pickle.dumps((ids[r].tolist(), n_terms, term[places], f[places], asked[r]), 5)

    return _rows(packs())


def scored(batches: Iterator[pa.RecordBatch], scopes: list, first: list, schema: pa.Schema, k: int, far: int, near: int, digits: int) -> Iterator[pa.RecordBatch]:
    """A key's queries come before its tables."""
    for key, own in itertools.groupby(_unpacked(batches), lambda x: x[0]):
        asked, held = [], iter(())
        for x in own:
            if x[1]:
                held = (x[2] for x in itertools.chain([x], own))
                break
            asked.append(x[2])
        x = None
        if asked and (table := next(held, None)):
            held, table = itertools.chain([table], held), None
            s = int(np.searchsorted(first, key, side="right")) - 1
            q, d, x = _best(asked, held, k, near if s == far else 0, digits)
            yield pa.RecordBatch.from_arrays([pa.array(q, schema.types[0]), pa.array([scopes[s]] * len(q), schema.types[1]), pa.array(d, schema.types[2]), pa.array(x, schema.types[3])], schema=schema)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, tuple]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.column("key")[i].as_py(), b.column("kind")[i].as_py(), pickle.loads(b.column("data")[i].as_buffer())
        b = None  # not kept beside the next one


def _best(asked: list, held: Iterable[tuple], k: int, near: int, digits: int) -> tuple[list, list, list]:
    q_ids = [x for p in asked for x in p[0]]
    q_count, q_term, q_f, q_asked = (np.concatenate([p[i] for p in asked]) for i in (1, 2, 3, 4))
    own, q_term = np.unique(q_term, return_inverse=True)
    v = len(own)
    if not v:
        return [], [], []

    def local(t: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(own, t), v - 1)
        return np.where(own[at] == t, at, -1)

    # Of each pack only what these queries ask for is kept; labels of all packs, each once.
    ids, seen, holds, kept, share, shares = [], {}, np.zeros(v, dtype=np.int64), [], [], []

    def put(end: int) -> None:
        """What was read last is scored at a time."""
        shares.append((shares[-1][1] if shares else 0, end, *map(np.concatenate, zip(*share))))
        share.clear()

    for names, dl, n_terms, term, f, n_own, own_labels, table, bonus, related in held:
        ids += names
        t = local(term)
        doc, f, t = np.repeat(np.arange(len(names)), n_terms)[t >= 0], f[t >= 0], t[t >= 0]
        holds += np.bincount(t, minlength=v)
        l_ends = np.cumsum(n_own + 1)
        label = np.full(int(l_ends[-1]), -1, dtype=np.int32)
        label[_spread(l_ends - n_own - 1, n_own)] = np.array([seen.setdefault(x, len(seen)) for x in table], dtype=np.int32)[own_labels]
        kept.append((dl, n_own.astype(np.int32), label, bonus, related))
        share.append((np.bincount(doc, minlength=len(names)).astype(np.int32), t.astype(np.min_scalar_type(v)), f.astype(np.min_scalar_type(f.max(initial=0)))))
        if len(ids) >= (shares[-1][1] if shares else 0) + AT_ONCE:
            put(len(ids))
    if share:
        put(len(ids))
    dl, n_own, labels, bonus, related = (np.concatenate(x) for x in zip(*kept))
    del kept, names, n_terms, term, own_labels, label, table, t, doc, f
    n, ids = len(ids), np.array(ids, dtype=object)
    idf = np.log(1.0 + (n - holds + 0.5) / (holds + 0.5))
    mean = max(dl.sum() / n, 1e-300)
    length = I.K1 * (1.0 - I.B + I.B * dl / mean)

    # The last label stands for none; each table has it once.
    m = len(seen)
    labels[labels < 0] = m
    of = np.repeat(np.arange(m), [len(x[1]) // 4 for x in seen])
    w = local(np.frombuffer(b"".join(x[1] for x in seen), dtype=np.int32))
    l_words = w[w >= 0]  # of each label its words
    l_from = np.r_[_starts(of[w >= 0], m), len(l_words)]
    order = np.argsort(w, kind="stable")
    order = order[np.searchsorted(w[order], 0) :]
    l_starts, l_of = _starts(w[order], v), of[order]
    width = np.array([x[0] for x in seen] + [1], dtype=float)
    l_ends = np.cumsum(n_own + 1, dtype=np.int64)
    l_first = l_ends - n_own - 1
    del seen
    flags = np.zeros(v, dtype=np.int64)

    def overlap(mine: list, at: np.ndarray) -> np.ndarray:
        """Largest overlap of the words with a label of these tables, from their labels only."""
        lengths = n_own[at] + 1
        those = labels[_spread(l_first[at], lengths)]
        n_words = l_from[those + 1] - l_from[those]
        flags[mine] = 1
        hits = np.r_[0, np.cumsum(flags[l_words[_spread(l_from[those], n_words)]])]
        flags[mine] = 0
        ends = np.cumsum(n_words)
        both = hits[ends] - hits[ends - n_words]
        return np.maximum.reduceat(both / (len(mine) + width[those] - both), np.cumsum(lengths) - lengths)

    def lifted(i: int, at: np.ndarray, got: np.ndarray, over: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best of these tables with rerank, and what ties with the k-th."""
        extra = R.LABEL_WEIGHT * over + bonus[at]
        if not q_asked[i]:
            extra = extra - np.where(related[at], R.RELATED_PENALTY, 0.0)
        return cut(at, got + extra)

    def cut(at: np.ndarray, got: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(got) > k:
            keep = got >= np.partition(got, len(got) - k)[len(got) - k] - slack
            at, got = at[keep], got[keep]
        return at, got

    slack = 1.5 * 10.0**-digits
    ends = np.cumsum(q_count)
    words = [(q_term[a:b].tolist(), q_f[a:b].tolist()) for a, b in zip(ends - q_count, ends)]
    best: list = [None] * len(words)
    for a, b, n_terms, term, f in shares:
        # Postings: of each word the tables that hold it and their weights.
        order = np.argsort(term, kind="stable")
        t, doc, weight = term[order], np.repeat(np.arange(b - a), n_terms)[order], f[order].astype(float)
        del order
        x = length[a:b][doc]
        x += weight
        weight *= I.K1 + 1.0
        weight /= x
        weight *= idf[t]
        del x
        here = np.bincount(t, minlength=v)
        starts = np.r_[0, np.cumsum(here)].tolist()
        dense: dict[int, np.ndarray] = {}
        for i in np.argsort(-here, kind="stable")[: DENSE_BYTES // (8 * (b - a))].tolist():
            if here[i] * 12 < b - a:
                break
            dense[i] = np.zeros(b - a)
            dense[i][doc[starts[i] : starts[i + 1]]] = weight[starts[i] : starts[i + 1]]
        s = np.empty(b - a)
        for i, (mine, times) in enumerate(words):
            s.fill(0.0)
            for x, c in zip(mine, times):
                if x in dense:
                    s += dense[x] if c == 1 else c * dense[x]
                elif starts[x] < starts[x + 1]:
                    p = slice(starts[x], starts[x + 1])
                    s[doc[p]] += weight[p] if c == 1 else c * weight[p]
            if near:
                # Below the near-th best so far nothing counts.
                old = best[i]
                at = _nearest(s, near, digits, ids[a:b], old[1].min() if old and len(old[0]) == near else 0.0)
                got = (at + a).astype(np.int32), np.round(s[at], digits)
                if old and len(at):
                    got = tuple(map(np.concatenate, zip(old, got)))
                    first = _first(got[1], near, got[0], ids)
                    got = got[0][first], got[1][first]
                best[i] = got if len(at) or not old else old
                continue
            at = np.flatnonzero(s > 0.0)
            if not len(at):
                continue
            got = s[at]
            hit = [l_of[l_starts[x] : l_starts[x + 1]] for x in mine]
            both = np.bincount(np.concatenate(hit), minlength=m + 1)
            over = both / (len(mine) + width - both)
            if len(at) * 2 > b - a:
                over = np.maximum.reduceat(over[labels[l_first[a] : l_ends[b - 1]]], l_first[a:b] - l_first[a])[at]
            else:
                lengths = n_own[a + at] + 1
                over = np.maximum.reduceat(over[labels[_spread(l_first[a + at], lengths)]], np.cumsum(lengths) - lengths)
            got = lifted(i, a + at, got, over)
            best[i] = got if best[i] is None else cut(*map(np.concatenate, zip(best[i], got)))
    out_q, out_d, out_s = [], [], []
    for i, got in enumerate(best):
        if got and len(got[0]):
            at, got = lifted(i, *got, overlap(words[i][0], got[0])) if near else got
            out_q += [q_ids[i]] * len(at)
            out_d += ids[at].tolist()
            out_s += got.tolist()
    return out_q, out_d, out_s


def _nearest(s: np.ndarray, near: int, digits: int, ids: np.ndarray, floor: float = 0.0) -> np.ndarray:
    """Places of the `near` largest scores above zero, rounded, and not below floor; ties by the id's text form."""
    wide = len(s) // 32
    top = s[: 32 * wide].reshape(32, wide).max(axis=0) if wide > 2 * near else np.zeros(0)
    if len(top):
        # The best of each of many groups are different tables: the near-th of them is no more than that of all.
        floor = max(floor, np.partition(top, wide - near)[wide - near])
    floor -= 10.0**-digits
    if len(top) and floor > 0:
        groups = np.flatnonzero(top >= floor)
        at = np.r_[np.add.outer(np.arange(0, 32 * wide, wide), groups).ravel(), np.arange(32 * wide, len(s))]
        at = at[s[at] >= floor]
    else:
        at = np.flatnonzero(s >= floor) if floor > 0 else np.flatnonzero(s)
    r = np.round(s[at], digits)
    at, r = at[r > 0], r[r > 0]
    return at[_first(r, near, at, ids)]


def _first(r: np.ndarray, near: int, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places in r of its `near` largest; ties by the text form of the id at `at`."""
    if len(r) <= near:
        return np.arange(len(r))
    least = np.partition(r, len(r) - near)[len(r) - near]
    more, even = np.flatnonzero(r > least), np.flatnonzero(r == least)
    return np.concatenate([more, np.array(sorted(even.tolist(), key=lambda i: str(ids[at[i]]))[: near - len(more)], dtype=np.int64)])
