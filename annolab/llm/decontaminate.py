"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and items become words (A-Z lower-cased; runs of digits, ASCII letters and
non-ASCII characters). Every run of ``ngram`` consecutive item words is a
pattern; an item with fewer words is one pattern. A document word inside an
occurrence of a pattern is hit.

Both sides are rewritten as `` w1 w2 ... wn `` so that a pattern is a byte string.
For each class of pattern lengths with least length m, a block shift table gives
for the last block of an m-byte window how far the window can move; only where
that is 0, the suffix-hash bucket names the patterns whose m-byte head ends in
this block, a prefix check thins them, and a direct comparison confirms. Many
windows move at once (one numpy lane per stretch of the texts).

One map-only pass over the documents per block of patterns: the pattern tables
are broadcast, at most ``block_bytes`` of item text each; a larger benchmark is
searched block after block, each pass adding to the hits of the one before.

Defined cases: NULL or wordless text has no words and no hits; NULL or wordless
items give no pattern; an item with NULL id still hits words but is not listed;
repeated items count once; repeated documents are separate rows; other columns
are kept (clashing result names are replaced).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolab.llm.common import U, annotate, once

NGRAM = 10
BLOCK_BYTES = 16 << 20
LANE = 2048
FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
             else 32 for b in range(256))
HASH = U(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list:
    return text.translate(FOLD).split() if text else []


class PatternClass:
    """Shift table, suffix buckets and prefixes of patterns of similar length."""

    def __init__(self, patterns: list):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.b = b = min(8, m)
        self.cut = U(8 * (8 - b))
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), dtype=np.uint8).reshape(-1, m)

        def block(end):
            wide = np.zeros((len(patterns), 8), dtype=np.uint8)
            wide[:, 8 - b:] = heads[:, end - b:end]
            return wide.view(U).ravel() >> self.cut

        self.bits = max(12, min(22, int(np.ceil(np.log2(len(patterns) * m + 1))) + 3))
        self.shift = np.full(1 << self.bits, m - b + 1, dtype=np.int32)
        for end in range(b, m + 1):                      # later ends give smaller shifts
            self.shift[self.slot(block(end))] = m - end
        suffix = block(m)
        order = np.argsort(suffix, kind="stable")
        self.member = order
        self.suffix, self.first = np.unique(suffix[order], return_index=True)
        self.last = np.append(self.first[1:], len(patterns))
        self.prefix = block(b)

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (block * HASH) >> U(64 - self.bits)

    def search(self, data: bytes, view: np.ndarray):
        """(start, pattern number) of every occurrence; ``view[i]`` holds bytes i..i+8."""
        size = len(data)
        lanes = np.arange(8 + self.m, size + 1, LANE, dtype=np.int64)
        cur, lim, hits = lanes.copy(), np.minimum(lanes + LANE, size + 1), []
        while len(cur):
            step = self.shift[self.slot(view[cur - 8] >> self.cut)]
            stop = step == 0
            if stop.any():
                hits.append(cur[stop])
                step[stop] = 1
            cur = cur + step
            on = cur < lim
            cur, lim = cur[on], lim[on]
        if not hits:
            return
        ends = np.concatenate(hits)
        at = np.searchsorted(self.suffix, view[ends - 8] >> self.cut)
        at[at == len(self.suffix)] = 0
        good = self.suffix[at] == view[ends - 8] >> self.cut
        ends, at = ends[good], at[good]
        n = self.last[at] - self.first[at]
        where = np.repeat(ends - self.m, n)
        which = self.member[np.repeat(self.first[at], n)
                            + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        same = view[where + self.b - 8] >> self.cut == self.prefix[which]
        pats = self.patterns
        for s, p in zip(where[same].tolist(), which[same].tolist()):
            if data[s:s + len(pats[p])] == pats[p]:
                yield s, p


class Matcher:
    """Patterns of a block of items, in classes by number of words."""

    def __init__(self, items: list, ngram: int):
        owners = defaultdict(set)
        for item, text in items:
            w = words(text)
            for i in range(max(1, len(w) - ngram + 1) if w else 0):
                owners[tuple(w[i:i + ngram])].add(item)
        classes = defaultdict(list)
        for p in owners:
            classes[min(len(p), ngram) if len(p) in (1, 2, ngram) else 3].append(p)
        self.classes = []
        for group in classes.values():
            group.sort()
            self.classes.append((PatternClass([b" " + b" ".join(p) + b" " for p in group]),
                                 [len(p) for p in group], [sorted(i for i in owners[p] if i is not None)
                                                           for p in group]))

    def search(self, texts: list):
        """(words per text, covered words as flat mask, items per text)"""
        norm = [words(t) for t in texts]
        n = np.array([len(w) for w in norm], dtype=np.int64)
        data = b"\n" * 8 + b"".join(b" " + b" ".join(w) + b" \n" if w else b"\n" for w in norm)
        raw = np.frombuffer(data + b"\n" * 8, dtype=np.uint8)
        view = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        spaces = np.flatnonzero(raw == 32)
        firsts = np.cumsum(np.where(n > 0, n + 1, 0)) - np.where(n > 0, n + 1, 0)   # first space of a text
        base = np.cumsum(n) - n
        step = np.zeros(int(n.sum()) + 1, dtype=np.int64)
        items = [set() for _ in texts]
        filled = np.flatnonzero(n > 0)
        for table, lengths, owners in self.classes:
            found = list(table.search(data, view))
            if not found:
                continue
            at = np.searchsorted(spaces, np.array([s for s, _ in found]))
            doc = filled[np.searchsorted(firsts[filled], at, side="right") - 1]
            word = base[doc] + at - firsts[doc]
            length = np.array([lengths[p] for _, p in found])
            np.add.at(step, word, 1)
            np.add.at(step, word + length, -1)
            for d, (_, p) in zip(doc.tolist(), found):
                items[d].update(owners[p])
        return n, np.cumsum(step[:-1]) > 0, items


def item_blocks(benchmark: DataFrame, block_bytes: int):
    """Items in blocks of bounded text size, streamed to the driver."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for item, text in rows.toLocalIterator():
        text = (text or "").encode()
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs plus n_words, n_hit (long), hit_words (packed bit per word) and items
    (sorted array of the item ids, as strings, that occur)."""
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
              T.StructField("hit_words", T.BinaryType()),
              T.StructField("items", T.ArrayType(T.StringType()))]
    sc, out = docs.sparkSession.sparkContext, None
    for block in item_blocks(benchmark, block_bytes):
        shared = sc.broadcast((block, ngram))
        if out is None:
            out = _pass(docs, shared, fields)
        else:
            out = _merge(_pass(out.withColumn("__before", F.struct("hit_words", "items")), shared, fields))
    return _pass(docs, sc.broadcast(([], ngram)), fields) if out is None else out


def _pass(docs: DataFrame, shared, fields) -> DataFrame:
    """The hits of one block of items."""

    def start():
        matcher = once(shared, lambda v: Matcher(*v))

        def work(texts):
            n, mask, items = matcher.search(texts)
            ends = np.cumsum(n)
            parts = np.split(mask, ends[:-1]) if len(n) else []
            return [n, np.array([int(p.sum()) for p in parts], dtype=np.int64),
                    [np.packbits(p).tobytes() for p in parts], [sorted(x) for x in items]]
        return work

    return annotate(docs, fields, start)


def _merge(df: DataFrame) -> DataFrame:
    """Unite the hits of this block with those of the blocks before."""
    schema = T.StructType([f for f in df.schema.fields if f.name != "__before"])

    def run(batches):
        for batch in batches:
            table = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            old = table["__before"].to_pylist()
            bits = [np.bitwise_or(np.frombuffer(a, np.uint8), np.frombuffer(b["hit_words"], np.uint8))
                    for a, b in zip(table["hit_words"].to_pylist(), old)]
            table["hit_words"] = pa.array([b.tobytes() for b in bits], pa.binary())
            table["n_hit"] = pa.array([int(np.unpackbits(b).sum()) for b in bits], pa.int64())
            table["items"] = pa.array([sorted({*a, *b["items"]}) for a, b in
                                       zip(table["items"].to_pylist(), old)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([table[f.name] for f in schema], names=schema.names)

    return df.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def brute_force(docs: list, items: list, ngram: int = NGRAM) -> dict:
    """{position of the document: (n_words, n_hit, sorted items)}, window by window."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text.encode() if text is not None else None)
        for i in range(max(1, len(w) - ngram + 1) if w else 0):
            windows[tuple(w[i:i + ngram])].add(item)
    out = {}
    for k, text in enumerate(docs):
        w = words(text.encode() if text is not None else None)
        hit, found = set(), set()
        for size in {len(p) for p in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out[k] = (len(w), len(hit), sorted(str(i) for i in found if i is not None))
    return out


def sha(items: list) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
