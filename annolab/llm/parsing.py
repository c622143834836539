"""Byte-level substring dedup by prefix-free parsing.

Rolling hashes cut the texts into phrases: the trigger of a ``length``-byte string
is the gram of ``GRAM`` bytes with the smallest hash among all its grams. It
depends on nothing but the string, so equal strings have the same trigger at the
same place, however the texts around them differ. Neighbouring strings with the
same trigger form a phrase (at most length - GRAM + 1 strings; trigger, left and
right context).

1. Dictionary and parse. A chunk of documents posts its distinct phrases, in the
   order (trigger, context) with the smallest document of each: the parse. In a
   hash bucket the parses merge into one order over all documents. A phrase that
   occurs in a smaller document is settled: all its strings are copies. Where one
   trigger has several phrases, strings that cross the phrases' differing edges
   may still be copies.
2. Suffixes of the dictionary. Only of those unsettled phrases the suffixes are
   ordered: each is posted by its first ``length`` bytes, merged over all
   documents, and told whether a smaller document comes first in its class.
   As only equality over ``length`` bytes matters, the order of suffixes is that
   of 62-bit fingerprints of these bytes (48 bits and the bucket's) instead of
   the alphabet's; a suffix array of all texts is never built.
3. Every byte that a copied string covers is removed.

In highly repetitive text the copies cost nothing after step 1, and a string or
phrase held by a third of all documents is posted once per chunk.

Defined cases: NULL text is empty; texts shorter than ``length`` lose nothing; a
document with NULL id neither loses bytes nor makes others lose them; rows that
share an id are one document in two rows (neither loses to the other); other
columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.llm import common as C
from annolab.llm.common import U

LENGTH = 50
GRAM = 24
CHUNK_BYTES = 2 << 20
SUFFIX_BYTES = 6
BYTE = np.random.default_rng(7).integers(1, 2 ** 63, 256, dtype=np.uint64)   # a random number per byte value
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def power(n: int) -> np.uint64:
    return U(pow(int(C.P1), n, 1 << 64))


def rolling(buf: np.ndarray, sizes: tuple) -> dict:
    """Polynomial hashes of all strings of the given sizes, by doubling."""
    have, size, out = BYTE[buf], 1, {}
    built = {n: None for n in sizes}
    done = {n: 0 for n in sizes}
    while True:
        for n in sizes:                                  # add this power of two where n has it
            if n & size:
                if built[n] is None:
                    built[n], done[n] = have.copy(), size
                else:
                    k = len(buf) - (done[n] + size) + 1
                    built[n] = have[:k] * power(done[n]) + built[n][size:size + k]
                    done[n] += size
        if size * 2 > max(sizes):
            break
        k = len(have) - size
        have = have[:k] * power(size) + have[size:]
        size *= 2
    out.update(built)
    return out


def sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    m, size = g, 1
    while size * 2 <= width:
        m = np.minimum(m[:len(m) - size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


class Phrases:
    """The phrases of a chunk."""

    def __init__(self, chunk: C.Chunk, length: int):
        self.chunk, self.length = chunk, length
        buf = np.frombuffer(chunk.data, dtype=np.uint8)
        self.size, width = len(buf), length - GRAM + 1
        self.heads = self.counts = np.zeros(0, dtype=np.int64)
        self.doc = np.zeros(0, dtype=np.int64)
        trigger = context = np.zeros(0, dtype=U)
        if self.size >= length:
            hashes = rolling(buf, (GRAM, length))
            self.full = hashes[length]
            low = sliding_min(C.mix(hashes[GRAM]), width)[:len(self.full)]
            valid = np.zeros(len(self.full), dtype=bool)
            mark = np.zeros(len(self.full) + 1, dtype=np.int32)
            some = chunk.lens >= length
            np.add.at(mark, chunk.starts[some], 1)
            np.add.at(mark, chunk.ends[some] - length + 1, -1)
            valid = np.cumsum(mark[:-1]) > 0
            at = np.flatnonzero(valid)
            if len(at):
                new = np.r_[True, (np.diff(at) > 1) | (low[at[1:]] != low[at[:-1]])]
                head = np.flatnonzero(new)
                run = at - np.repeat(at[head], np.diff(np.r_[head, len(at)]))
                head = np.flatnonzero(run % width == 0)
                self.heads = at[head]
                self.counts = np.diff(np.r_[head, len(at)])
                trigger = C.mix(low[self.heads])
                context = C.mix(self.full[self.heads] * C.P1 + self.full[self.heads + self.counts - 1] * C.P2
                                + self.counts.astype(U))
                self.doc = np.searchsorted(chunk.ends, self.heads, side="right")
        order = np.lexsort((context, trigger))
        t, c = trigger[order], context[order]
        new = np.r_[True, (t[1:] != t[:-1]) | (c[1:] != c[:-1])][:len(t)]
        self.unique = order[new]                       # first (smallest document) of each distinct phrase
        self.trigger, self.context = t[new], c[new]
        self.which = np.empty(len(t), dtype=np.int64)  # distinct phrase of each phrase
        self.which[order] = np.cumsum(new) - 1
        self.ids = chunk.order_ids()[self.doc]         # by phrase

    def suffixes(self, unsettled: np.ndarray):
        """Distinct strings of the unsettled phrases: keys and smallest ids."""
        p = self.unique[unsettled]
        n = self.counts[p]
        at = np.repeat(self.heads[p], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = C.mix(self.full[at]) if len(at) else np.zeros(0, dtype=U)
        ids = np.repeat(self.ids[p], n)
        order = np.lexsort((ids, key))
        key, ids = key[order], ids[order]
        new = np.r_[True, key[1:] != key[:-1]][:len(key)]
        return key[new], ids[new]


def post_phrases(length: int, lb: int):
    def run(batches):
        for row in C.rows_of(batches):
            p = Phrases(C.Chunk(row), length)
            ids = p.ids[p.unique].view(U)
            yield C.request_batch(row["chunk"], [
                (b, j - i, C.key_payload(p.trigger[i:j], lb) + C.planes(p.context[i:j], 5) + C.planes(ids[i:j], 8))
                for b, i, j in C.cut_buckets(p.trigger, lb)])
    return run


def _split(payloads: list, widths: tuple) -> tuple:
    """Key array, other columns, sizes of concatenated payloads."""
    total = sum(widths)
    sizes = [len(p) // total for p in payloads]
    columns = [np.concatenate([C.keys_back(p[:widths[0] * n], widths[0]) for p, n in zip(payloads, sizes)])]
    at = widths[0]
    for w in widths[1:]:
        columns.append(np.concatenate([C.unplanes(p[at * n:(at + w) * n], w) for p, n in zip(payloads, sizes)]))
        at += w
    return columns, sizes


def merge_parses(payloads: list) -> list:
    """Two answers per phrase: settled (a smaller document has it), unsettled."""
    (key, context, ids), sizes = _split(payloads, (5, 5, 8))
    ids = ids.view(np.int64)
    order = np.lexsort((ids, context, key))
    k, c, d = key[order], context[order], ids[order]
    by_key = np.r_[True, k[1:] != k[:-1]]
    by_phrase = by_key | np.r_[True, c[1:] != c[:-1]]
    phrase = np.cumsum(by_phrase) - 1
    firsts = d[by_phrase]                                 # smallest document of each phrase
    group = (np.cumsum(by_key) - 1)[by_phrase]            # its trigger
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    differ = np.minimum.reduceat(firsts, starts) != np.maximum.reduceat(firsts, starts)
    settled, unsettled = np.empty(len(k), dtype=bool), np.empty(len(k), dtype=bool)
    settled[order] = d > firsts[phrase]
    unsettled[order] = (d == firsts[phrase]) & differ[group][phrase]
    cuts = np.cumsum(sizes)[:-1]
    return [np.concatenate([np.packbits(a), np.packbits(b)])
            for a, b in zip(np.split(settled, cuts), np.split(unsettled, cuts))]


def two_answers(rep: list | None) -> tuple:
    parts = sorted(rep or [], key=lambda r: r["bucket"])
    none = np.zeros(0, dtype=bool)
    out = []
    for half in (0, 1):
        bits = []
        for r in parts:
            size = len(r["bits"]) // 2
            bits.append(np.unpackbits(np.frombuffer(r["bits"][half * size:(half + 1) * size], dtype=np.uint8),
                                      count=r["n"]))
        out.append(np.concatenate(bits).astype(bool) if bits else none)
    return tuple(out)


def post_suffixes(length: int, lb: int):
    def run(batches):
        for row in C.rows_of(batches):
            p = Phrases(C.Chunk(row), length)
            _, unsettled = two_answers(row["rep"])
            key, ids = p.suffixes(unsettled)
            yield C.request_batch(row["chunk"], [
                (b, j - i, C.key_payload(key[i:j], lb, SUFFIX_BYTES) + C.planes(ids[i:j].view(U), 8))
                for b, i, j in C.cut_buckets(key, lb)])
    return run


def merge_suffixes(payloads: list) -> list:
    """Answer: does a smaller document hold the string?"""
    (key, ids), sizes = _split(payloads, (SUFFIX_BYTES, 8))
    ids = ids.view(np.int64)
    order = np.lexsort((ids, key))
    k, d = key[order], ids[order]
    head = np.r_[True, k[1:] != k[:-1]]
    out = np.empty(len(k), dtype=bool)
    out[order] = d > d[head][np.cumsum(head) - 1]
    return [np.packbits(x) for x in np.split(out, np.cumsum(sizes)[:-1])]


def copied(p: Phrases, settled: np.ndarray, unsettled: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Mask of the bytes of a chunk that copied strings cover."""
    step = np.zeros(p.size + 1, dtype=np.int32)
    if len(p.heads):
        first = p.ids[p.unique][p.which]
        whole = settled[p.which] | (p.ids > first)
        whole &= p.chunk.known[p.doc]
        np.add.at(step, p.heads[whole], 1)
        np.add.at(step, p.heads[whole] + p.counts[whole] - 1 + p.length, -1)
        part = np.flatnonzero(~whole & unsettled[p.which] & p.chunk.known[p.doc])
        if len(part):
            keys, ids = p.suffixes(unsettled)
            n = p.counts[part]
            at = np.repeat(p.heads[part], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            where = np.searchsorted(keys, C.mix(p.full[at]))
            own = np.repeat(p.ids[part], n)
            at = at[(smaller[where]) | (own > ids[where])]
            np.add.at(step, at, 1)
            np.add.at(step, at + p.length, -1)
    return np.cumsum(step[:-1]) > 0


def cut_out(length: int):
    def run(batches):
        for row in C.rows_of(batches):
            chunk = C.Chunk(row)
            gone = copied(Phrases(chunk, length), *two_answers(row["rep"]), C.reply_bits(row["smaller"]))
            buf = np.frombuffer(chunk.data, dtype=np.uint8)
            out = []
            for d, (a, b) in enumerate(zip(chunk.starts.tolist(), chunk.ends.tolist())):
                g = gone[a:b]
                n = int(g.sum())
                spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if n else 0
                out.append((int(chunk.ids[d]) if chunk.known[d] else None, b - a, n, spans,
                            buf[a:b][~g].tobytes() if n else chunk.data[a:b]))
            for i in range(0, len(out), 1024):
                cols = list(zip(*out[i:i + 1024]))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols[:4]]
                                                 + [pa.array(cols[4], pa.binary())],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def dedup(docs: DataFrame, length: int = LENGTH, finish=lambda df: df) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining
    bytes). ``finish`` maps this to the columns to be written."""
    s = C.Scratch(docs.sparkSession, "parsing")
    chunks = C.chunk_table(s, docs, CHUNK_BYTES)
    lb = C.bucket_bits(chunks)
    rep = s.table(C.exchange(chunks.mapInArrow(post_phrases(length, lb), C.REQUEST), merge_parses), "phrases")
    known = chunks.join(rep, "chunk", "left")
    smaller = s.table(C.exchange(known.mapInArrow(post_suffixes(length, lb), C.REQUEST), merge_suffixes),
                      "suffixes").withColumnRenamed("rep", "smaller")
    return s.result(finish(known.join(smaller, "chunk", "left").mapInArrow(cut_out(length), RESULT)))


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list, length: int = LENGTH) -> list:
    """docs: (id, text). [(id, bytes, removed, spans, kept)] string by string."""
    first: dict = {}
    data = [(i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for j in range(len(b) - length + 1):
            if i is not None:
                first[b[j:j + length]] = min(first.get(b[j:j + length], i), i)
    out = []
    for i, b in data:
        gone = [False] * len(b)
        for j in range(len(b) - length + 1):
            if i is not None and first[b[j:j + length]] < i:
                gone[j:j + length] = [True] * length
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out
