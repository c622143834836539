"""Periodic runs of words by a dictionary of basic factors.

For L = 1, 2, 4, ... every L consecutive words get a name, equal words equal names: the name
of a factor of 2 L words is made of the names of its halves, exactly (names are ranks of
pairs, not hashes). Where a factor occurs next, at distance d with L <= d < 2 L, and again d
further on, the three occurrences form an arithmetic progression that proposes the period d.
A run of period q and at least 4 q words has such a progression at the level L <= q < 2 L, in
any q consecutive positions of its first q: fewer than q / 2 + 1 different factors of L words
would make the run's period smaller, so one of them occurs once per period. A proposal
counts if the 3 d words from it are a cube, which the names of the blocks at both ends of
each d words decide; the smallest period of the cube is then d, as a smaller one would
have brought the factor back earlier. Cubes of one period that overlap in at least two
periods belong to one run; what is left of a run on both sides of its cubes is shorter than
two periods and is extended word by word, all runs of a level side by side.

A factor that occurs once in its document has no part in a longer one that repeats, so it
leaves the dictionary, and the levels soon hold repeated passages only. Documents are
handled many at a time, as one array; memory is a few numbers per word of a batch.

Defined cases: NULL, empty and short texts have no run; a NULL id is never rewritten by
``planted``; rows that repeat an id are rows of their own; a very long text is a batch of
its own and is never cut; of runs with the same exponent the smaller start, then the smaller
period is reported; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.llm.common import as_bytes, ship

LEAST = 6                   # words of a run
TIMES = 4                   # periods of a run
BATCH_BYTES = 4 << 20
BATCH_DOCS = 4096
RESULT = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long,"
          " runs binary, collapsed binary")


def planted(doc_id: int | None, n: int) -> tuple[int, int]:
    """(a, p): every word i >= a stands for word a + (i - a) % p; (n, 1) leaves all as it is."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return n, 1
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def pairs_named(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For factors in order of position: their names, which of them occur again in their
    document, and the index of the next occurrence there (-1: none)."""
    order = np.argsort(key, kind="stable")
    k, d = key[order], doc[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    name = np.empty(len(k), dtype=np.int64)
    name[order] = np.cumsum(new) - 1
    follow = np.full(len(k), -1, dtype=np.int64)
    again = ~new[1:] & (d[1:] == d[:-1])
    follow[order[:-1][again]] = order[1:][again]
    repeated = follow >= 0
    repeated[follow[repeated]] = True
    return name, repeated, follow


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, by document, start and period.
    ``words``: a number per word of all documents, equal for equal words."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    doc_of = np.repeat(np.arange(len(sizes)), sizes)
    limit = ends[doc_of]
    name = words.astype(np.int64)
    at = np.arange(len(words))
    key, size, found = name, 1, []
    while len(at):
        named, repeated, follow = pairs_named(key, doc_of[at])
        name = np.full(len(words), -1, dtype=np.int64)
        name[at[repeated]] = named[repeated]
        step = np.zeros(len(at), dtype=np.int64)             # to the next occurrence
        has = follow >= 0
        step[has] = at[follow[has]] - at[has]
        # progressions of three; only distances from L to 2 L belong to this level
        one = np.flatnonzero((step >= size) & (step < 2 * size))
        one = one[step[follow[one]] == step[one]]
        i, d = at[one], step[one]
        inside = i + 3 * d <= limit[i]
        i, d = i[inside], d[inside]
        x, y, z = name[i + d - size], name[i + 2 * d - size], name[i + 3 * d - size]
        cube = (x >= 0) & (x == y) & (y == z)
        if cube.any():
            found.append(_extended(words, starts, ends, doc_of, i[cube], d[cube]))
        at = at[repeated]
        at = at[at + 2 * size <= limit[at]]
        at = at[name[at + size] >= 0]
        key = name[at] * len(words) + name[at + size]
        size *= 2
        # a run of the next level has TIMES * size words at least
        at_fits = sizes[doc_of[at]] >= TIMES * size
        at, key = at[at_fits], key[at_fits]
    if not found:
        return np.zeros((0, 4), dtype=np.int64)
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _extended(words, starts, ends, doc_of, i, d) -> np.ndarray:
    """The runs around cubes of period d that begin at i (one row per run)."""
    order = np.lexsort((i, d))
    i, d = i[order], d[order]
    new = np.ones(len(i), dtype=bool)                       # overlaps of two periods or more stay together
    new[1:] = (d[1:] != d[:-1]) | (i[1:] - i[:-1] > d[1:])
    heads = np.flatnonzero(new)
    low, q = i[heads].copy(), d[heads]
    high = i[np.r_[heads[1:], len(i)] - 1] + 3 * q
    doc = doc_of[low]
    for edge, move in ((low, -1), (high, 1)):
        live = np.arange(len(q))
        while len(live):
            e = edge[live]
            if move < 0:
                on = e > starts[doc[live]]
                live, e = live[on], e[on]
                same = words[e - 1] == words[e - 1 + q[live]]
            else:
                on = e < ends[doc[live]]
                live, e = live[on], e[on]
                same = words[e] == words[e - q[live]]
            live = live[same]
            if len(live) < 8:                               # few left: each in one comparison
                for r in live.tolist():
                    edge[r] += _stretch(words, int(edge[r]), int(q[r]), move, int(starts[doc[r]]), int(ends[doc[r]]))
                break
            edge[live] += move
    ok = high - low >= np.maximum(LEAST, TIMES * q)
    return np.stack([doc[ok], (low - starts[doc])[ok], (high - low)[ok], q[ok]], 1)


def _stretch(words, e: int, q: int, move: int, first: int, end: int) -> int:
    """How far (signed) the edge of a run of period q moves."""
    n, block = 0, max(64, 2 * q)
    while True:
        if move > 0:
            a, b = e + n, min(end, e + n + block)
            bad = np.flatnonzero(words[a:b] != words[a - q:b - q])
            size = b - a
        else:
            a, b = max(first, e - n - block), e - n
            bad = np.flatnonzero(words[a:b][::-1] != words[a + q:b + q][::-1])
            size = b - a
        if len(bad):
            return move * (n + int(bad[0]))
        n += size
        if size < block:
            return move * n


def best(runs: list) -> tuple | None:
    """(start, length, period) of the greatest exponent, compared exactly."""
    top = None
    for s, n, q in runs:
        if top is None or n * top[2] > top[1] * q or (n * top[2] == top[1] * q and (s, q) < (top[0], top[2])):
            top = s, n, q
    return top


def analyse(ids: list, texts: list, rewrite=planted) -> list:
    """Rows of RESULT for texts (bytes or None)."""
    number: dict = {}
    split, parts = [], []
    for i, t in zip(ids, texts):
        w = (t or b"").split()
        a, p = rewrite(i, len(w)) if rewrite else (len(w), 1)
        if a < len(w):
            head, cycle = w[:a], w[a:a + p]
            w = head + (cycle * ((len(w) - a) // p + 1))[:len(w) - a]
        split.append(w)
        parts += w
    words = np.fromiter((number.setdefault(x, len(number)) for x in parts), dtype=np.int64, count=len(parts))
    runs = find_runs(words, np.array([len(w) for w in split], dtype=np.int64))
    cuts = np.searchsorted(runs[:, 0], np.arange(len(split) + 1)).tolist()
    out = []
    for k, (i, w) in enumerate(zip(ids, split)):
        own = [tuple(r) for r in runs[cuts[k]:cuts[k + 1], 1:].tolist()]
        kept = w
        if own:
            mark = np.zeros(len(w) + 1, dtype=np.int64)
            for s, n, q in own:
                mark[s + q] += 1
                mark[s + n] -= 1
            kept = [w[j] for j in np.flatnonzero(np.cumsum(mark)[:-1] == 0).tolist()]
        s, n, q = best(own) or (None, None, None)
        out.append((i, len(w), len(own), s, n, q, None if q is None else 1000 * n // q,
                    "".join(f"{s},{n},{q}\n" for s, n, q in own).encode(), b" ".join(kept)))
    return out


def periodic_runs(docs: DataFrame, rewrite=planted) -> DataFrame:
    """One row per document: doc_id, n_words, n_runs; start, length, period, exponent_milli of
    the run of greatest exponent; runs ('start,length,period' lines) and collapsed (the text
    without repetitions), as UTF-8. ``rewrite``: (id, words) -> (a, p) as ``planted``, or None.
    Map-only."""
    ship(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    types = (pa.int64(),) * 7 + (pa.binary(),) * 2
    names = [f.split()[0] for f in RESULT.split(", ")]

    def packs(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                if ids and (size + len(t or b"") > BATCH_BYTES or len(ids) >= BATCH_DOCS):
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
        if ids:
            yield ids, texts

    def run(batches):
        for ids, texts in packs(batches):
            rows = analyse(ids, texts, rewrite)
            for x in range(0, len(rows), 256):
                cols = zip(*rows[x:x + 256])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return base.mapInArrow(run, RESULT)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    return df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                     F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def brute_force(docs: list, rewrite=planted) -> list:
    """docs: (id, text). (id, runs as sorted (start, length, period), kept words), every
    stretch of every period looked at."""
    out = []
    for i, t in docs:
        w = (t or "").encode().split()
        a, p = rewrite(i, len(w)) if rewrite else (len(w), 1)
        w = [w[j] if j < a else w[a + (j - a) % p] for j in range(len(w))]
        runs: list = []
        for q in range(1, len(w) // TIMES + 1):
            j = 0
            while j + q < len(w):
                e = j
                while e + q < len(w) and w[e] == w[e + q]:
                    e += 1
                if e > j:
                    s, n = j, e - j + q
                    smaller = any(all(w[x] == w[x + r] for x in range(s, s + n - r)) for r in range(1, q))
                    if n >= max(LEAST, TIMES * q) and not smaller:
                        runs.append((s, n, q))
                j = e + 1
        gone = {x for s, n, q in runs for x in range(s + q, s + n)}
        out.append((i, sorted(runs, key=lambda r: (r[0], r[2])), [x for j, x in enumerate(w) if j not in gone]))
    return out
