"""SentencePiece encoding and decoding by a streaming Viterbi search.

The encoder maximises the sum of the piece scores of the model file over all
segmentations of the normalised text (spaces become U+2581, one is put in front).
It walks over the text once, keeping scores only for the last ``max piece
length`` positions, and commits ids as soon as the backpointer paths of all
surviving positions run through one boundary. Between two characters that no
piece holds side by side every path has a boundary; the text is first cut at
those that are quick to see (before a run of spaces, around line ends), and such segments are
remembered, so frequent words are searched once per worker; the new segments of a
batch are searched together, one numpy lane each, position by position.

A character without a piece becomes its UTF-8 bytes' pieces (cost: 10 below the
lowest score, as in the unigram model); a literal U+2581 is written by bytes, so
decode(encode(text)) == text for every text. Of equal sums the longer last piece
wins. The scores are integers or floats summed exactly enough in doubles from the
last committed boundary on, not from the start of the text.

Note on the vocabulary: the file at hand is of the BPE kind; its scores are merge
ranks. The ids are the best-scoring segmentation under these scores (what the
unigram search gives for this file), not the result of replaying the merges.

Defined cases: NULL text gives NULL ids and NULL decoded text, an empty text no
ids; repeated rows are encoded alike; other columns are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from annolab.llm.common import P1, U, annotate, once, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CACHE = 400_000            # remembered segments per worker process
SEGMENT = re.compile(" +[^ \n]*|\n+|[^ \n]+")


class Prefixes:
    """Hash table of all beginnings of the pieces: which are pieces, their ids and scores."""

    def __init__(self, ids: dict, score: dict):
        names = sorted({p[:k] for p in ids for k in range(1, len(p) + 1)})
        self.names = names
        h = np.zeros(len(names), dtype=U)
        for i, n in enumerate(names):
            v = 0
            for c in n:
                v = (v * int(P1) + ord(c)) & 0xFFFFFFFFFFFFFFFF
            h[i] = v
        self.id = np.array([ids.get(n, -1) for n in names], dtype=np.int32)
        self.score = np.array([score.get(n, -np.inf) for n in names])
        # open addressing in rounds: whoever finds its slot taken moves on with the next multiplier
        self.bits = int(np.ceil(np.log2(len(names) + 1))) + 2
        self.rounds, left = [], np.arange(len(names))
        for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                  0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165):
            slot = (h[left] * U(m)) >> U(64 - self.bits)
            keys, where = np.zeros(1 << self.bits, dtype=U), np.full(1 << self.bits, -1, dtype=np.int32)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], where[slot[first]] = h[left[first]], left[first]
            self.rounds.append((U(m), keys, where))
            left = np.delete(left, first)
            if not len(left):
                break
        if len(left) or len(np.unique(h)) < len(h):
            raise ValueError("the beginnings of the pieces do not fit the table")

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the beginnings with these hashes, -1 for none."""
        out = np.full(len(h), -1, dtype=np.int32)
        todo = np.arange(len(h))
        for m, keys, where in self.rounds:
            slot = (h[todo] * m) >> U(64 - self.bits)
            at = where[slot]
            hit = (keys[slot] == h[todo]) & (at >= 0)
            out[todo[hit]] = at[hit]
            todo = todo[~hit & (at >= 0)]              # an empty slot ends the search
            if not len(todo):
                break
        return out


class Pieces:
    """Vocabulary of a model file (its bytes) with encoder and decoder."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.ids, self.score, self.text, self.byte = {}, {}, [b""] * n, {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte[value], self.text[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                key = piece.replace(SPACE, " ")
                self.ids[key], self.score[key] = i, sp.get_score(i)
                self.text[i] = key.encode()
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.score.values(), default=0.0) - 10.0
        self.can_cut = not any(" " in p.lstrip(" ") or "\n" in p for p in self.ids)
        self.unk = sp.unk_id()
        self.prefixes = Prefixes(self.ids, self.score)
        self.seen: dict = {}

    def segment(self, text: str) -> list:
        """Ids of a normalised stretch, by the streaming search."""
        out, n, longest = [], len(text), self.longest
        best, back = {0: 0.0}, {}                       # by position
        done = 0                                        # committed up to here
        score = self.score
        for end in range(1, n + 1):
            top, origin = None, -1
            for start in range(max(done, end - longest), end):
                if (prev := best.get(start)) is None:
                    continue
                s = score.get(text[start:end])
                if s is None:
                    if end - start > 1:
                        continue
                    s = self.unknown
                if top is None or prev + s > top:
                    top, origin = prev + s, start
            best[end], back[end] = top, origin
            best.pop(end - longest, None)
            if end - done >= 4 * longest and end % longest == 0:
                meet = self.converged(best, back, done)
                if meet > done:
                    out += self.commit(text, back, done, meet)
                    floor = best.get(meet, 0.0)
                    best = {p: v - floor for p, v in best.items()}
                    for p in range(done, meet + 1):
                        back.pop(p, None)
                    done = meet
        return out + self.commit(text, back, done, n)

    @staticmethod
    def converged(best: dict, back: dict, done: int) -> int:
        """The last boundary on the paths of all surviving positions."""
        alive = set(best)
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(back.get(last, done) if last > done else done)
        return alive.pop()

    def commit(self, text: str, back: dict, start: int, end: int) -> list:
        cuts = [end]
        while cuts[-1] > start:
            cuts.append(back[cuts[-1]])
        out = []
        for b, a in zip(cuts[-2::-1], cuts[:0:-1]):
            i = self.ids.get(text[a:b])
            out += [i] if i is not None else [self.byte.get(x, self.unk) for x in text[a:b].encode()]
        return out

    def together(self, segments: list) -> list:
        """Ids (as int32 bytes) of equally long segments without literal U+2581, searched
        at once; None where a character has no piece."""
        n, w = len(segments[0]), len(segments)
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32).reshape(w, n).astype(U)
        best = np.full((n + 1, w), -np.inf)
        best[0] = 0.0
        start, piece = np.zeros((n + 1, w), dtype=np.int32), np.full((n + 1, w), -1, dtype=np.int32)
        for s in range(n):
            lane, h = np.arange(w), np.zeros(w, dtype=U)
            for end in range(s + 1, min(n, s + self.longest) + 1):
                h = h * P1 + chars[lane, end - 1]
                at = self.prefixes.find(h)
                on = at >= 0                           # some piece begins like this
                lane, h, at = lane[on], h[on], at[on]
                if not len(lane):
                    break
                total = best[s, lane] + self.prefixes.score[at]
                better = total > best[end, lane]
                up = lane[better]
                best[end, up], start[end, up], piece[end, up] = total[better], s, self.prefixes.id[at[better]]
        steps, at, k = np.zeros((w, n), dtype=np.int32), np.full(w, n), np.zeros(w, dtype=np.int64)
        lane = np.arange(w)
        known = np.isfinite(best[n])
        lane = lane[known]
        while len(lane):
            steps[lane, n - 1 - k[lane]] = piece[at[lane], lane]
            at[lane], k[lane] = start[at[lane], lane], k[lane] + 1
            lane = lane[at[lane] > 0]
        return [steps[i, n - k[i]:].tobytes() if ok else None for i, ok in enumerate(known.tolist())]

    def learn(self, segments) -> None:
        """Search the segments that are not remembered yet."""
        new = [x for x in segments if x not in self.seen]
        if len(self.seen) + len(new) > CACHE:
            self.seen.clear()
            new = list(segments)
        by_length: dict = {}
        for x in new:
            if len(x) <= 40 and SPACE not in x:
                by_length.setdefault(len(x), []).append(x)
            else:
                self.seen[x] = np.array(self.segment(x), dtype=np.int32).tobytes()
        for group in by_length.values():
            for i in range(0, len(group), 8192):
                part = group[i:i + 8192]
                for x, got in zip(part, self.together(part)):
                    # a character without a piece: the search that falls back to bytes
                    self.seen[x] = np.array(self.segment(x), dtype=np.int32).tobytes() if got is None else got

    def encode_many(self, texts: list) -> list:
        """Id arrays of texts (None for None)."""
        out: list = []
        for at in range(0, len(texts), 256):
            cut = [None if not t else SEGMENT.findall(" " + t) if self.can_cut else [" " + t] for t in texts[at:at + 256]]
            self.learn(dict.fromkeys(x for parts in cut if parts for x in parts))
            get = self.seen.__getitem__
            out += [np.frombuffer(b"".join(map(get, parts)), dtype=np.int32) if parts else
                    None if t is None else np.zeros(0, dtype=np.int32) for t, parts in zip(texts[at:at + 256], cut)]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids) -> bytes:
        out = b"".join(map(self.text.__getitem__, ids))
        return out[1:] if out[:1] == b" " else out


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """docs plus ids (array<int>) and n_tokens (long)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        vocabulary = once(shared, Pieces)

        def work(texts):
            got = vocabulary.encode_many([None if t is None else t.decode() for t in texts])
            lens = [0 if g is None else len(g) for g in got]
            offsets = np.zeros(len(got) + 1, dtype=np.int32)
            np.cumsum(lens, out=offsets[1:])
            values = np.concatenate([g for g in got if g is not None] or [np.zeros(0, dtype=np.int32)])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()),
                                           mask=pa.array([g is None for g in got]))
            return [ids, [None if g is None else n for g, n in zip(got, lens)]]
        return work

    return annotate(docs, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType())], start, text)


def decode(df: DataFrame, model: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df plus the text of its ids (NULL for NULL)."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    base = df.select(*[c for c in df.columns if c != out])
    at = base.columns.index(ids)
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        vocabulary = once(shared, Pieces)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                column = part.column(at)
                flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                texts = [vocabulary.decode(flat[a:b].tolist()).decode("utf-8", "replace") if there else None
                         for a, b, there in zip(ends, ends[1:], column.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return base.mapInArrow(run, schema)
