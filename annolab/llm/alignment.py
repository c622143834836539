"""Alignment of two tokenizers by pointer jumping over overlapping tokens.

Both tokenizers cut the same bytes, so their tokens form a chain of overlaps. Every token
points to the farthest-right token that it overlaps: a token of A to the B token that holds
its last byte, a token of B to the A token that holds its last byte if that one reaches
further, else to itself. Doubling the successors (next = next[next]) until nothing changes
leads every token of a component to its terminal token, a B token whose end is also the
end of an A token; the terminals number the groups. Many documents are doubled together, as
one array: no component crosses the end of a text.

1. ``encoded`` runs both tokenizers once and packs, per few MB of text, the groups' digests,
   the distinct linked id pairs with their counts, and the links as numbers of these pairs.
2. The pairs are counted over the corpus (each task sums its own first), the highest count
   of each B id follows. Both are bounded by the vocabularies, not by the corpus.
3. The most frequent pairs (at most ``heavy``) are broadcast and looked up map-side; the
   others are rare by definition and join their counts by key, so no key of the join is hot.

Defined cases: NULL and empty texts, and texts whose joined token bytes are not
space + text in either vocabulary (a literal U+2581), have no tokens: zeros and ''. Rows
that repeat an id are rows of their own, a NULL id stays NULL; other columns are left out.
A text is never cut; a very long one is a pack of its own. An empty table gives no rows.
Ties of a B id's highest count all count as best.

The byte-level file is read as a list of merges: where its ids follow the order of its merges
(checked), the faster library finds the same ids; else the file's own library is used.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annolab.llm import common as C
from annolab.llm.common import once, ship

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
HEAVY = 1 << 19            # broadcast pairs, 17 bytes each
PACK_BYTES = 1 << 20       # text bytes per pack
PACK_DOCS = 8192
#: how the byte-level file splits a text before merging (fixed value, as in /opt/tokenizers)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PACK = ("pack long, ids binary, known binary, n_a binary, n_b binary, n_groups binary, sha binary,"
        " pairs binary, counts binary, stream binary")
ROWS = ("at long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
        " groups_sha256 string, rare array<struct<pair: long, times: long>>")


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def byte_of_char() -> dict:
    """The character that a byte-level vocabulary writes for each byte, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytesBPE:
    """The byte-level tokenizer: ids of space + text."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, back = spec["model"], byte_of_char()
        special = {t["content"] for t in spec.get("added_tokens", ())}
        ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        self.text = [b""] * (max(model["vocab"].values()) + 1)
        for t, i in ranks.items():
            self.text[i] = t
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"]["".join(p)] for p in pairs]
        pre = spec.get("pre_tokenizer") or {}
        if order == sorted(order) and len(set(order)) == len(order) == len(ranks) - 256 \
                and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer"):
            fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda text: fast.encode_to_numpy(text, disallowed_special=())
        else:
            slow = Tokenizer.from_str(data.decode())
            slow.encode_special_tokens = True
            self.encode = lambda text: slow.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list) -> list:
        return [np.asarray(self.encode(" " + t), dtype=np.int32) for t in texts]


class Pieces:
    """The piece tokenizer: ids of text, in front of which it puts a space itself."""

    def __init__(self, data: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.text = []
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            self.text.append(bytes([int(piece[3:-1], 16)]) if self.sp.is_byte(i)
                             else piece.replace("▁", " ").encode())

    def ids(self, texts: list) -> list:
        return self.sp.encode(texts, num_threads=1)


class Decimals:
    """Writes arrays of ids as decimal text."""

    def __init__(self, ids: int):
        self.width = len(str(max(1, ids - 1)))
        n = np.arange(ids)
        self.digits = np.zeros((ids, self.width + 1), dtype=np.uint8)
        self.used = np.zeros((ids, self.width + 1), dtype=bool)
        for k in range(self.width):
            self.digits[:, self.width - 1 - k] = 48 + n // 10 ** k % 10
            self.used[:, self.width - 1 - k] = (n >= 10 ** k) | (k == 0)

    def write(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids, each followed by its separator (0: none); the text's length per id."""
        digits, used = self.digits[ids], self.used[ids]
        digits[:, -1], used[:, -1] = ends, ends != 0
        return digits[used].tobytes(), used.sum(1)


class Aligner:
    """Both tokenizers and their alignment of a list of texts."""

    def __init__(self, files: tuple[bytes, bytes]):
        self.a, self.b = BytesBPE(files[0]), Pieces(files[1])
        self.len_a = np.array([len(t) for t in self.a.text], dtype=np.int64)
        self.len_b = np.array([len(t) for t in self.b.text], dtype=np.int64)
        self.decimals = Decimals(max(len(self.len_a), len(self.len_b)))

    def tokens(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, ids of B, tokens per text in A, in B) of texts (str or None); no tokens
        where a vocabulary does not spell the text."""
        texts, none = [t or "" for t in texts], np.zeros(0, dtype=np.int32)
        ids_a, ids_b = self.a.ids(texts), self.b.ids(texts)
        for i, t in enumerate(texts):
            spelt = (" " + t).encode() if t else None
            # the byte-level ids spell every text whose length they have
            if spelt is None or b"".join(map(self.b.text.__getitem__, ids_b[i])) != spelt \
                    or int(self.len_a[ids_a[i]].sum()) != len(spelt):
                ids_a[i] = ids_b[i] = none
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
        return (np.concatenate([none, *ids_a]),
                np.fromiter(chain.from_iterable(ids_b), dtype=np.int32, count=int(n_b.sum())), n_a, n_b)

    def align(self, texts: list) -> Alignment:
        return Alignment(self, *self.tokens(texts))


class Alignment:
    """Groups and links of many documents at once. Arrays run over the tokens of all."""

    def __init__(self, own: Aligner, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.own, self.a, self.b, self.n_a, self.n_b = own, a, b, n_a, n_b
        end_a, end_b = np.cumsum(own.len_a[a], dtype=np.int64), np.cumsum(own.len_b[b], dtype=np.int64)
        self.to_b, self.to_a = _holder(end_b, end_a), _holder(end_a, end_b)   # the other token with the last byte
        self.stops = end_a[self.to_a] == end_b
        m = np.int32(len(a))
        follow = np.concatenate([m + self.to_b, np.where(
            self.stops, m + np.arange(len(b), dtype=np.int32), self.to_a)])
        while True:                                        # successor doubling
            double = follow[follow]
            if np.array_equal(double, follow):
                break
            follow = double
        number = np.cumsum(self.stops, dtype=np.int32) - 1                 # of a terminal
        label = number[follow - m]
        self.group_a, self.group_b = label[:m], label[m:]
        self.last_b = np.cumsum(self.n_b)
        upto = np.r_[0, np.cumsum(self.stops)]
        self.n_groups = upto[self.last_b] - upto[self.last_b - self.n_b]
        self.n_links = self.n_a + self.n_b - self.n_groups

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Id pairs (a * B ids + b) of all links: those that end with their A token, in
        order, then the others, which end with their B token."""
        size = len(self.own.len_b)
        inner = ~self.stops
        first, other = self.a.astype(np.int64), self.b.astype(np.int64)
        return first * size + other[self.to_b], first[self.to_a[inner]] * size + other[inner]

    def spelt(self) -> list:
        """Per document: its groups as 'a1,a2|b1;a3|b2,b3' in ASCII."""
        n = int(self.stops.sum())
        size_a, size_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        until_a, until_b = np.cumsum(size_a, dtype=np.int32), np.cumsum(size_b, dtype=np.int32)
        m = len(self.a) + len(self.b)
        ids, sep = np.zeros(m, dtype=np.int32), np.full(m, 44, dtype=np.uint8)
        is_a = np.repeat(np.tile([True, False], n), np.stack([size_a, size_b], 1).ravel())
        ids[is_a], ids[~is_a] = self.a, self.b
        sep[until_a + until_b - size_b - 1] = 124
        sep[until_a + until_b - 1] = 59
        last = np.cumsum(self.n_a + self.n_b)
        sep[last[self.n_a > 0] - 1] = 0
        text, lengths = self.own.decimals.write(ids, sep)
        upto = np.r_[0, np.cumsum(lengths)][np.r_[0, last]].tolist()
        return [text[x:y] for x, y in zip(upto, upto[1:])]


def _holder(ends: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The token, of those with these ends, that holds the byte before each place of ``of``."""
    if not len(ends):
        return np.zeros(0, dtype=np.int32)
    mark = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    mark[ends] = 1
    return np.cumsum(mark, dtype=np.int32)[of - 1]


def distinct(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique with inverse and counts; codes are below ``limit``. Sorting code and place
    as one number is several times as fast as sorting places by code."""
    bits = max(1, int(len(codes)).bit_length())
    if limit << bits >= 1 << 63:
        return np.unique(codes, return_inverse=True, return_counts=True)
    both = np.sort((codes << bits) | np.arange(len(codes)))
    code, place = both >> bits, both & ((1 << bits) - 1)
    head = np.r_[True, code[1:] != code[:-1]][:len(code)]
    inverse = np.empty(len(codes), dtype=np.int64)
    inverse[place] = np.cumsum(head) - 1
    starts = np.flatnonzero(head)
    return code[starts], inverse, np.diff(np.r_[starts, len(code)])


def _packs(batches):
    """Lists of (ids, texts) of bounded size."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):             # few texts as objects at once
            part = batch.slice(at, 256)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if ids and (size + len(t or "") > PACK_BYTES or len(ids) >= PACK_DOCS):
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t or "")
    if ids:
        yield ids, texts


def _share(docs: DataFrame, a_file: str, b_file: str):
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((read_file(a_file), read_file(b_file)))
    return shared, docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               F.col("text").cast("string").alias("text"))


def alignments(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """One row per document: doc_id, the token ids of both tokenizers and the number of the
    group (from 0, in order) of every token. Map-only."""
    shared, base = _share(docs, a_file, b_file)

    def run(batches):
        tool = once(shared, Aligner)
        for ids, texts in _packs(batches):
            al = tool.align(texts)
            before = np.cumsum(al.n_groups) - al.n_groups
            cols = [np.split(of, np.cumsum(n)[:-1]) for of, n in (
                (al.a, al.n_a), (al.b, al.n_b), (al.group_a, al.n_a), (al.group_b, al.n_b))]
            for c in cols[2:]:
                c[:] = [g - k for g, k in zip(c, before)]
            for x in range(0, len(ids), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[x:x + 64], pa.int64())]
                    + [pa.array([v.astype(np.int32) for v in c[x:x + 64]], pa.list_(pa.int32())) for c in cols],
                    names=["doc_id", "a_ids", "b_ids", "a_group", "b_group"])

    return base.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>")


def encoded(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Rows of PACK."""
    shared, base = _share(docs, a_file, b_file)

    def run(batches):
        tool, z = once(shared, Aligner), zstandard.ZstdCompressor(level=1)
        part = TaskContext.get().partitionId()
        for seq, (ids, texts) in enumerate(_packs(batches)):
            al = tool.align(texts)
            first, rest = al.links()
            pairs, stream, counts = distinct(np.concatenate([first, rest]), len(tool.len_a) * len(tool.len_b))
            sha = [hashlib.sha256(t).digest() for t in al.spelt()]
            known = np.array([i is not None for i in ids], dtype=np.uint8)
            row = [(part << 32) | seq, np.array([i or 0 for i in ids], dtype=np.int64).tobytes(), known.tobytes(),
                   al.n_a.tobytes(), al.n_b.tobytes(), al.n_groups.astype(np.int64).tobytes(), b"".join(sha),
                   z.compress(C.planes(np.diff(pairs, prepend=0).astype(C.U), 8)),
                   z.compress(C.planes(counts.astype(C.U), 8)), z.compress(C.planes(stream.astype(C.U), 4))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64() if k == 0 else pa.binary()) for k, v in enumerate(row)],
                names=[f.split()[0] for f in PACK.split(", ")])

    return base.mapInArrow(run, PACK)


def _unzip(data: bytes, width: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return C.unplanes(raw, width).astype(np.int64) if raw else np.zeros(0, dtype=np.int64)


def pair_rows(size: int):
    def run(batches):
        for row in C.rows_of(batches):
            pairs, counts = np.cumsum(_unzip(row["pairs"], 8)), _unzip(row["counts"], 8)
            for x in range(0, len(pairs), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[x:x + 65536]), pa.array(pairs[x:x + 65536] % size),
                                                  pa.array(counts[x:x + 65536])], names=["pair", "b", "n"])
    return run


def pair_counts(packs: DataFrame, size: int) -> DataFrame:
    """(pair, n, best): corpus-wide number of links of each id pair, and whether it is the
    highest of its B id. A B id has at most as many pairs as A has ids."""
    n = (packs.select("pairs", "counts").mapInArrow(pair_rows(size), "pair long, b long, n long")
         .groupBy("pair", "b").agg(F.sum("n").alias("n")))
    return n.select("pair", "n", (F.col("n") == F.max("n").over(Window.partitionBy("b"))).alias("best"))


def heavy_from(stats: DataFrame, heavy: int) -> int:
    """The smallest step of count (sixteenths of a power of two) from which on at most
    ``heavy`` pairs follow."""
    steps = stats.groupBy(_step()).count().collect()        # a few hundred rows
    total, at = 0, 1 << 30
    for r in sorted(steps, key=lambda r: -r[0]):
        total += r[1]
        if total > heavy:
            break
        at = r[0]
    return at


def _step():
    return F.floor(F.log2(F.col("n").cast("double")) * 16).cast("long")


def look_up(shared, size: int):
    """Rows of ROWS from packs: sums over the links whose pair is broadcast; the others are
    listed in ``rare``."""
    def run(batches):
        pair, n, best = shared.value
        for row in C.rows_of(batches):
            ids, known = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["known"], dtype=np.uint8)
            n_a, n_b, n_groups = (np.frombuffer(row[c], dtype=np.int64) for c in ("n_a", "n_b", "n_groups"))
            pairs, stream = np.cumsum(_unzip(row["pairs"], 8)), _unzip(row["stream"], 4)
            at = np.minimum(np.searchsorted(pair, pairs), max(0, len(pair) - 1))
            found = pair[at] == pairs if len(pair) else np.zeros(len(pairs), dtype=bool)
            value, top = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
            value[found], top[found] = n[at[found]], best[at[found]]
            ends_a, ends_r = np.cumsum(n_a), np.cumsum(n_b - n_groups)
            split = int(ends_a[-1])

            def per_doc(v):                                  # of both halves of the stream
                x, y = np.r_[0, np.cumsum(v[:split])], np.r_[0, np.cumsum(v[split:])]
                return x[ends_a] - x[ends_a - n_a] + y[ends_r] - y[ends_r - (n_b - n_groups)]

            count_sum, n_best = per_doc(value[stream]), per_doc(top[stream])
            rare: list = [[] for _ in ids]
            odd = np.flatnonzero(~found[stream])
            if len(odd):
                doc = np.where(odd < split, np.searchsorted(ends_a, odd, "right"),
                               np.searchsorted(ends_r, odd - split, "right"))
                keys, times = np.unique(doc * len(pairs) + stream[odd], return_counts=True)
                for k, t in zip(keys.tolist(), times.tolist()):
                    rare[k // len(pairs)].append({"pair": int(pairs[k % len(pairs)]), "times": t})
            sha = row["sha"]
            hexed = [sha[32 * i:32 * i + 32].hex() if a else "" for i, a in enumerate(n_a.tolist())]
            links = n_a + n_b - n_groups
            cols = [np.arange(len(ids)) + (row["pack"] << 13), pa.array(ids, mask=known == 0), n_a, n_b, n_groups, links,
                    n_best, count_sum, hexed, pa.array(rare, pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=[
                "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"])
    return run


def link_statistics(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, heavy: int = HEAVY) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 (of the groups' ids)."""
    spark = docs.sparkSession
    s = C.Scratch(spark, "alignment")
    size = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    packs = s.table(encoded(docs, a_file, b_file), "packs")
    stats = s.table(pair_counts(packs, size), "pairs")
    least = heavy_from(stats, heavy)
    top = stats.where(_step() >= least).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))
    rows = s.table(packs.mapInArrow(look_up(shared, size), ROWS), "rows")
    rare = (rows.where(F.size("rare") > 0).select("at", F.explode("rare").alias("r"))
            .select("at", "r.pair", "r.times").join(stats.where(_step() < least), "pair")
            .groupBy("at").agg(F.sum(F.col("times") * F.col("n")).alias("more"),
                               F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")))
    out = rows.drop("rare").join(rare, "at", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
    return s.result(out)


def brute_force(docs: list, a_file: str = A_FILE, b_file: str = B_FILE) -> list:
    """docs: (id, text). Rows as of ``link_statistics``: byte ranges compared one by one, ids
    from the files' own libraries."""
    slow, sp = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
    slow.encode_special_tokens = True
    back, b_text = byte_of_char(), Pieces(read_file(b_file)).text
    found, counts = [], {}
    for i, t in docs:
        a = slow.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        at = [bytes(back[c] for c in slow.id_to_token(x)) for x in a]
        bt = [b_text[x] for x in b]
        if not t or b"".join(at) != (" " + t).encode() or b"".join(bt) != b"".join(at):
            found.append((i, [], [], [], []))
            continue
        ra, rb = [], []
        for toks, out in ((at, ra), (bt, rb)):
            p = 0
            for x in toks:
                out.append((p, p + len(x)))
                p += len(x)
        links = [(a[x], b[y]) for x, (s, e) in enumerate(ra) for y, (u, v) in enumerate(rb) if s < v and u < e]
        for p in links:
            counts[p] = counts.get(p, 0) + 1
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups = []
        for lo, hi in zip([0, *ends], ends):
            groups.append(",".join(str(x) for x, (s, e) in zip(a, ra) if lo <= s < hi) + "|"
                          + ",".join(str(x) for x, (s, e) in zip(b, rb) if lo <= s < hi))
        found.append((i, a, b, groups, links))
    top: dict = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [(i, len(a), len(b), len(g), len(l), sum(counts[p] == top[p[1]] for p in l), sum(counts[p] for p in l),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, g, l in found]
