"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of text in that
language, in lower case and without punctuation; a text, rewritten likewise,
is compressed, piece by piece, with every dictionary, and the
language whose dictionary gives the fewest bytes wins. When the best is not
clearly better than the second, the row is marked ``rejected``.

Training: a bounded sample per language. A training text offers one piece of at most
``SPAN`` bytes that begins at a hash-chosen place anywhere in it, so all of every text may be
drawn; pieces are drawn by a hash of id and text, so that about four dictionaries' worth are
expected, and the lowest hashes fill ``dict_bytes``. What a language has is counted over all
rows first. Then all dictionaries are cut to the size of the smallest (of those of ``EVEN`` bytes
or more: a language with hardly any text does not cut the others). Neither the
order nor the partitions of the rows matter. The dictionaries (languages x dict_bytes) are broadcast;
prediction is map-only and reads whole texts.

Defined cases: NULL text or text without a letter is ``und`` with score 0; equal
sizes go to the alphabetically first language; rows whose language is NULL train
nothing; without any training row every prediction is ``und``; repeated rows are
predicted alike and enter a dictionary again only when every other piece is in; very long texts are read whole, piece by piece; other columns are
kept, those named as a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolab.llm.common import annotate, as_bytes, once, ship

DICT_BYTES = 96 << 10
SPAN = 2048                # bytes of a text that may enter a dictionary
EVEN = 16 << 10            # size from which a dictionary may cut the others
MAX_LANGUAGES = 4096       # of the dictionaries that are broadcast (checked)
PIECE = 4096
LEVEL = 3
MARGIN = 0.01
LETTER = regex.compile(r"\p{L}")
#: ASCII characters other than letters become spaces
PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def fold(text: bytes) -> bytes:
    """Lower case, ASCII non-letters as single spaces: case and punctuation say
    nothing about the language."""
    return b" ".join(text.decode("utf-8", "replace").lower().encode().translate(PLAIN).split())


def piece_of(text: bytes, h: int, span: int = SPAN) -> bytes:
    """The folded piece of a text that its hash chooses."""
    at = h % max(1, len(text) - span + 1)
    while at and text[at] & 0xC0 == 0x80:                    # not inside a character
        at -= 1
    return fold(text[at:at + span].decode("utf-8", "ignore").encode())


def dictionaries(train: DataFrame, dict_bytes: int = DICT_BYTES, span: int = SPAN) -> dict:
    """{language: bytes}"""
    ship(train.sparkSession)
    h = F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    base = train.where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").select(
        F.col("lang").cast("string").alias("lang"), F.pmod(h, F.lit((1 << 62))).alias("h"), F.col("text").cast("string").alias("text"))
    sizes = base.groupBy("lang").agg(F.sum(F.least(F.octet_length("text"), F.lit(span))).alias("bytes"))
    langs = {r["lang"]: r["bytes"] for r in sizes.limit(MAX_LANGUAGES + 1).collect()}
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(4.0 * dict_bytes) / F.col("bytes")).alias("share"))
    # at most MAX_LANGUAGES rows, as just checked
    drawn = (base.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("h"), F.lit(1 << 52)) < F.col("share") * F.lit(float(1 << 52)))
             .select("lang", "h", "text"))

    def cut(batches):
        for batch in batches:
            pieces = [piece_of(t, h, span) for h, t in zip(batch.column(1).to_pylist(), as_bytes(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pieces, pa.binary())],
                                             names=["lang", "h", "piece"])

    def join(key, table):
        rows = sorted(zip(table.column("h").to_pylist(), table.column("piece").to_pylist(), table.column("n").to_pylist()))
        out = b""
        while rows and len(out) < dict_bytes:                # every piece once, then second copies, and so on
            for _, piece, _ in rows:
                if len(out) >= dict_bytes:
                    break
                out += piece + b"\n"
            rows = [(h, piece, n - 1) for h, piece, n in rows if n > 1]
        return pa.table({"lang": pa.array([key[0].as_py()]), "content": pa.array([out[:dict_bytes]], pa.binary())})

    # a language's group: about 4 dict_bytes, as repeated rows are one with their count
    pieces = drawn.mapInArrow(cut, "lang string, h long, piece binary").groupBy("lang", "h", "piece").agg(F.count("*").alias("n"))
    rows = pieces.groupBy("lang").applyInArrow(join, "lang string, content binary").collect()
    found = {r["lang"]: bytes(r["content"]) for r in sorted(rows, key=lambda r: r["lang"])}
    even = min([len(c) for c in found.values() if len(c) >= EVEN], default=dict_bytes)
    return {lang: c[:even] for lang, c in found.items()}


class Coder:
    """Compressed sizes of a text under every language's dictionary."""

    def __init__(self, content: dict, level: int = LEVEL):
        self.langs = sorted(content)
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang] or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False,
                                                        write_checksum=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list:
        pieces = [text[i:i + PIECE] for i in range(0, len(text), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.coders]

    def predict(self, text: bytes | None):
        """(language, score, rejected margin ratio)"""
        if not text or not self.langs or not LETTER.search(text.decode("utf-8", "replace")):
            return "und", 0.0, 0.0
        sizes = self.sizes(fold(text))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.langs[i]))
        if len(order) == 1:
            return self.langs[0], 1.0, 1.0
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / second
        return self.langs[order[0]], 1.0 - float(np.exp(-20.0 * margin)), margin


def identify(docs: DataFrame, content: dict, margin: float = MARGIN) -> DataFrame:
    """docs plus lang_pred, score (0..1, grows with the margin) and rejected
    (the margin is below ``margin`` of the second size)."""
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def start():
        coder = once(shared, Coder)

        def work(texts):
            rows = [coder.predict(t) for t in texts]
            return [[r[0] for r in rows], [r[1] for r in rows], [r[2] < margin for r in rows]]
        return work

    return annotate(docs, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())], start)
