"""Substring dedup by De Bruijn compaction.

The k consecutive words of a window are an edge of a De Bruijn graph; its nodes
are the k-1 words that two neighbouring windows share. Only edges that occur in
two or more documents matter:

1. Edges. Every chunk of documents posts its distinct edges to hash buckets; a
   bucket answers which of them another chunk (or another document of the chunk)
   holds too. Unrepeated edges end here.
2. Compaction. Nodes between repeated edges are posted with the edges that enter
   and leave them. A node is a cut where more than one edge enters or leaves, or
   where a document's run of repeated edges begins or ends. Joined back, the cuts
   divide each run into paths without a branch: every occurrence of an edge lies
   in the same path, so a path is all there is to compare.
3. Verification. A path is identified by a 128-bit digest of its actual words at
   its source coordinates (document, first word, length); the smallest document
   of a path keeps it, in the others its words are removed.

What travels: 5 bytes per distinct edge and chunk, 9 per node of repeated edges,
one row per distinct path and chunk. Hashes only propose (a false match leaves a path
with one source); hot passages are posted once per chunk.

Defined cases: NULL, empty and short texts have no window and lose nothing; a
document with NULL id neither loses words nor makes others lose them; rows that
share an id are one document in two rows (neither loses to the other); other
columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.llm import common as C
from annolab.llm.common import U

K = 13
PATHS = "chunk long, n int, least long, most long, digest binary, places binary"
RESULT = ("doc_id long, n_words long, n_removed long, kept binary, spans binary")


class Windows:
    """The edges (windows of k words) and nodes (k-1 words) of a chunk."""

    def __init__(self, chunk: C.Chunk, k: int):
        self.chunk, self.k = chunk, k
        self.words = [t.split() for t in chunk.texts()]
        self.n = np.array([len(w) for w in self.words], dtype=np.int64)
        self.ends = np.cumsum(self.n)
        self.starts = self.ends - self.n
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        flat = C.hash_words([x for w in self.words for x in w])
        m = max(0, len(flat) - k + 1)
        self.valid = np.zeros(len(flat) + 1, dtype=bool)
        self.valid[:m] = np.arange(m) + k <= self.ends[self.doc[:m]]
        self.edge = np.zeros(len(flat) + 1, dtype=U)
        self.node = np.zeros(len(flat) + 1, dtype=U)
        if m:
            self.edge[:m] = C.gram_hashes(flat, k)
            self.node[:m + 1] = C.gram_hashes(flat, k - 1)
        self.at = np.flatnonzero(self.valid)
        self.keys, self.inverse = np.unique(self.edge[self.at], return_inverse=True)

    def local(self) -> np.ndarray:
        """Edges that two documents of this chunk hold."""
        doc = self.doc[self.at]
        last = np.zeros(len(self.keys), dtype=doc.dtype)
        last[self.inverse] = doc
        return C.first_in_group(self.inverse, doc, len(self.keys)) != last

    def runs(self, shared: np.ndarray):
        """Marks the repeated windows; then the nodes next to them with their keys."""
        flags = self.local()
        if len(shared):
            flags |= shared
        self.hot = np.zeros(len(self.valid), dtype=bool)
        self.hot[self.at] = flags[self.inverse]
        left = np.zeros(len(self.hot), dtype=bool)          # window before, same document, repeated
        left[1:] = self.hot[:-1]
        first = np.zeros(len(self.hot), dtype=bool)
        first[self.starts[self.n > 0]] = True
        left &= ~first
        self.pos = np.flatnonzero(self.hot | left)          # nodes by the word they begin at
        into = np.where(left[self.pos], np.roll(self.edge, 1)[self.pos], U(0))
        out = np.where(self.hot[self.pos], self.edge[self.pos], U(0))
        pair = (C.mix(into * C.P1 + out) >> U(32)) | U(1)
        pair[~(left & self.hot)[self.pos]] = 0              # a run begins or ends here
        self.nodes, self.node_inverse = np.unique(self.node[self.pos], return_inverse=True)
        one = C.first_in_group(self.node_inverse, pair, len(self.nodes))
        mixed = np.zeros(len(self.nodes), dtype=bool)
        mixed[self.node_inverse[pair != one[self.node_inverse]]] = True
        one[mixed] = 0
        return one

    def paths(self, cut: np.ndarray):
        """(document, first word, number of words) of the unbranched paths."""
        is_cut = np.zeros(len(self.hot), dtype=bool)
        if len(self.pos):
            is_cut[self.pos] = cut[self.node_inverse]
        at = np.flatnonzero(self.hot)
        if not len(at):
            return
        new = np.r_[True, (np.diff(at) > 1) | (self.doc[at[1:]] != self.doc[at[:-1]])] | is_cut[at]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.r_[heads, len(at)]) + self.k - 1
        for start, size in zip(at[heads].tolist(), sizes.tolist()):
            d = int(self.doc[start])
            yield d, start - int(self.starts[d]), size


def post_edges(k: int, lb: int):
    def run(batches):
        for row in C.rows_of(batches):
            w = Windows(C.Chunk(row), k)
            yield C.request_batch(row["chunk"], [(b, j - i, C.key_payload(w.keys[i:j], lb))
                                                 for b, i, j in C.cut_buckets(w.keys, lb)])
    return run


def post_nodes(k: int, lb: int):
    def run(batches):
        for row in C.rows_of(batches):
            w = Windows(C.Chunk(row), k)
            pair = w.runs(C.reply_bits(row["rep"]))
            yield C.request_batch(row["chunk"], [
                (b, j - i, C.key_payload(w.nodes[i:j], lb) + C.planes(pair[i:j], 4))
                for b, i, j in C.cut_buckets(w.nodes, lb)])
    return run


def cuts(payloads: list) -> list:
    """Answer: is the node a cut? (key planes, then 4 planes of the edge pair)"""
    sizes = [len(p) // 9 for p in payloads]
    key = np.concatenate([C.keys_back(p[:5 * n]) for p, n in zip(payloads, sizes)])
    pair = np.concatenate([C.unplanes(p[5 * n:], 4) for p, n in zip(payloads, sizes)])
    order = np.argsort(key, kind="stable")
    k, p = key[order], pair[order]
    head = np.r_[True, k[1:] != k[:-1]]
    starts = np.flatnonzero(head)
    low, high = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)
    bad = ((low == 0) | (low != high))[np.cumsum(head) - 1]
    out = np.empty(len(key), dtype=bool)
    out[order] = bad
    return [np.packbits(x) for x in np.split(out, np.cumsum(sizes)[:-1])]


def find_paths(k: int):
    def run(batches):
        for row in C.rows_of(batches):
            chunk = C.Chunk(row)
            w = Windows(chunk, k)
            w.runs(C.reply_bits(row["rep"]))
            cut = C.reply_bits(row["cut"])
            found: dict = {}
            for d, s, n in w.paths(cut if len(cut) else np.zeros(len(w.nodes), dtype=bool)):
                key = hashlib.blake2b(b" ".join(w.words[d][s:s + n]), digest_size=16).digest(), n
                found.setdefault(key, []).append((d, s))
            rows = []
            for (digest, n), places in found.items():
                ids = [int(chunk.ids[d]) for d, _ in places if chunk.known[d]]
                if ids:
                    rows.append((row["chunk"], n, min(ids), max(ids), digest, np.array(places, dtype=np.int32).tobytes()))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["chunk", "n", "least", "most", "digest", "places"])
    return run


def cut_out(batches):
    """Remove the spans; one row per document."""
    for row in C.rows_of(batches):
        chunk = C.Chunk(row)
        spans: dict = {}
        for r in row["spans"] or []:
            for d, start in np.frombuffer(r["places"], dtype=np.int32).reshape(-1, 2).tolist():
                if chunk.known[d] and chunk.ids[d] > r["first_id"]:
                    spans.setdefault(d, []).append((start, start + r["n"]))
        out = []
        for d, text in enumerate(chunk.texts()):
            words = text.split()
            merged: list = []
            for a, b in sorted(spans.get(d, [])):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept += words[at:a]
                at = b
            kept += words[at:]
            out.append((int(chunk.ids[d]) if chunk.known[d] else None, len(words), len(words) - len(kept),
                        b" ".join(kept), np.array(merged, dtype=np.int64).tobytes()))
        for i in range(0, len(out), 1024):
            part = out[i:i + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                 pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.binary()),
                 pa.array([r[4] for r in part], pa.binary())],
                names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def repeated_paths(s: C.Scratch, chunks: DataFrame, k: int) -> DataFrame:
    """The paths (PATHS) of edges that occur in two or more documents: one row per chunk
    and path, with its smallest and largest id and its places (document, first word)."""
    lb = C.bucket_bits(chunks)
    rep = s.table(C.exchange(chunks.mapInArrow(post_edges(k, lb), C.REQUEST), C.repeated), "repeated")
    known = chunks.join(rep, "chunk", "left")
    cut = s.table(C.exchange(known.mapInArrow(post_nodes(k, lb), C.REQUEST), cuts), "cuts")
    both = known.join(cut.withColumnRenamed("rep", "cut"), "chunk", "left")
    return s.table(both.mapInArrow(find_paths(k), PATHS), "paths")


def dedup(docs: DataFrame, k: int = K, finish=lambda df: df) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the remaining words,
    UTF-8), spans (removed word ranges, packed int64 pairs). ``finish`` maps this to
    the columns to be written."""
    s = C.Scratch(docs.sparkSession, "debruijn")
    chunks = C.chunk_table(s, docs)
    paths = repeated_paths(s, chunks, k)
    first = paths.groupBy("digest").agg(F.min("least").alias("first_id"))
    spans = (paths.join(first, "digest").where("most > first_id").groupBy("chunk")
             .agg(F.collect_list(F.struct("n", "first_id", "places")).alias("spans")))
    return s.result(finish(chunks.join(spans, "chunk", "left").mapInArrow(cut_out, RESULT)))


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns."""
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list, k: int = K) -> list:
    """docs: (id, text). [(id, words, removed, kept text)] window by window."""
    first: dict = {}
    split = [(i, t.encode().split() if t else []) for i, t in docs]
    for i, w in split:
        for j in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[j:j + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for j in range(len(w) - k + 1):
            if i is not None and first[tuple(w[j:j + k])] < i:
                gone.update(range(j, j + k))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), b" ".join(kept).decode()))
    return out
