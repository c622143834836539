"""Helpers shared by the operators: shipping the package to the workers, written
intermediate tables, Arrow row mapping, word hashing, and the packed chunk table
with its grouped exchange.

Chunks. The duplicate operators look at one text several times, each time with a
little more knowledge about it. ``chunk_table`` packs the documents once, zstd
compressed, a few MB of text per row, into a table bucketed by chunk; joining
the knowledge gathered meanwhile on ``chunk`` then needs no shuffle of texts.

Exchange. A chunk does not send one row per window but, for each of B hash
ranges ("buckets"), one packed array of its distinct keys; ``groupBy(bucket)``
brings the arrays of a range together and the answer is an array in the same
order. A key that occurs in a third of all rows is sent once per chunk.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolab.session import shared_folder
from annolab.session import ship_package as ship

CHUNK_BYTES = 4 << 20      # text bytes per chunk (a longer text is a chunk of its own)
CHUNK_DOCS = 8192
BUCKET_BYTES = 4 << 20     # text bytes per exchange bucket
U = np.uint64

class Scratch:
    """Written intermediate tables of one operator run; ``close`` removes them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self.tables: list[str] = []

    def table(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write and reread: cuts lineage, survives lost executors, is computed once."""
        path = f"{self.root}/{name}"
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """As ``table``, bucketed by ``key``: later joins on it don't shuffle this side."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        t = f"llm_{name}_{uuid.uuid4().hex}"
        (df.repartition(n, key).write.format("parquet").bucketBy(n, key)
         .option("path", f"{self.root}/{name}").saveAsTable(t))
        self.tables.append(t)
        return self.spark.table(t)

    def result(self, df: DataFrame) -> DataFrame:
        """Write the result, drop everything else, return the written result (deleted
        when the driver ends)."""
        path = f"{self.root}-result"
        df.write.mode("overwrite").parquet(path)
        self.close()
        fs, at = self.place(path)
        fs.deleteOnExit(at)
        return self.spark.read.schema(df.schema).parquet(path)

    def place(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def close(self) -> None:
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        fs, at = self.place(self.root)
        fs.delete(at, True)


# ------------------------------------------------------------------ Arrow rows
def as_bytes(column) -> list:
    """Values of a string column as bytes (None stays None)."""
    return column.cast(pa.binary()).to_pylist()


def annotate(df: DataFrame, fields: list[T.StructField], fn, text: str = "text") -> DataFrame:
    """Map over the rows of ``df``, keeping its columns: ``fn()`` is called once per
    task and returns a function from a list of texts (bytes or None) to a list of
    columns, one per field. Existing columns of the same names are replaced."""
    ship(df.sparkSession)
    names = {f.name for f in fields}
    keep = [f.name for f in df.schema.fields if f.name not in names]
    # a kept string is read where it is: texts cross to the workers once
    there = text in keep and df.schema[text].dataType == T.StringType()
    base = df.select(*[F.col(f"`{c}`") for c in keep],
                     *[] if there else [F.col(f"`{text}`").cast("string").alias("__text")])
    at_text = keep.index(text) if there else len(keep)
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    types = [to_arrow(f.dataType) for f in fields]

    def run(batches):
        work = fn()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cols = work(as_bytes(part.column(at_text)))
                yield pa.RecordBatch.from_arrays(
                    part.columns[:len(keep)]
                    + [c if isinstance(c, pa.Array) else pa.array(c, t)
                       for c, t in zip(cols, types)], names=schema.names)

    return base.mapInArrow(run, schema)


_built: dict = {}


def once(shared, build):
    """What ``build`` makes of a broadcast value, made once per worker process (the last
    one is kept)."""
    if shared not in _built:
        _built.clear()
        _built[shared] = build(shared.value)
    return _built[shared]


def forget() -> None:
    """Give back what ``once`` has built for an operator that ran before in this worker
    process, and Arrow's unused memory."""
    _built.clear()
    pa.default_memory_pool().release_unused()


def to_arrow(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(to_arrow(t.elementType))
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
            "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[t.simpleString()]


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n (NULL for a NULL id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


# ------------------------------------------------------------------ hashing
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
P1 = U(0x9E3779B97F4A7C15)
P2 = U(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * P2
    return x ^ (x >> U(29))


def hash_words(words: list) -> np.ndarray:
    """64-bit hash of each word."""
    h = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.fromiter(map(h.__getitem__, words), dtype=U, count=len(words))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values (k >= 1, at least k values)."""
    m = len(values) - k + 1
    out = values[:m].copy()
    for j in range(1, k):
        out *= P1
        out += values[j:j + m]
    return mix(out)


# ------------------------------------------------------------------ chunks
CHUNK_SCHEMA = "chunk long, docs int, bytes long, ids binary, known binary, lens binary, blob binary"


def chunk_table(scratch: Scratch, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: ids (int64), known (id not NULL), lens (int64) and the
    compressed texts of its documents, by ascending id. NULL text = empty text."""
    spark = scratch.spark
    ship(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))

    def pack(batches):
        forget()
        part, seq, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
        z = zstandard.ZstdCompressor(level=1)

        def row():
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            known = np.array([ids[i] is not None for i in order], dtype=np.uint8)
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([(part << 32) | seq], pa.int64()),
                "docs": pa.array([len(ids)], pa.int32()), "bytes": pa.array([size], pa.int64()),
                "ids": pa.array([np.array([ids[i] or 0 for i in order], dtype=np.int64).tobytes()], pa.binary()),
                "known": pa.array([known.tobytes()], pa.binary()),
                "lens": pa.array([np.array([len(texts[i]) for i in order], dtype=np.int64).tobytes()], pa.binary()),
                "blob": pa.array([z.compress(b"".join(texts[i] for i in order))], pa.binary())})

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                t = t or b""
                if ids and (size + len(t) > chunk_bytes or len(ids) >= CHUNK_DOCS):
                    yield row()
                    seq, ids, texts, size = seq + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield row()

    return scratch.bucketed(base.mapInArrow(pack, CHUNK_SCHEMA), "chunks", "chunk")


class Chunk:
    """A row of the chunk table on a worker."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.known = np.frombuffer(row["known"], dtype=np.uint8).astype(bool)
        self.lens = np.frombuffer(row["lens"], dtype=np.int64)
        self.data = zstandard.ZstdDecompressor().decompress(row["blob"]) if row["bytes"] else b""
        self.ends = np.cumsum(self.lens)
        self.starts = self.ends - self.lens

    def texts(self) -> list:
        return [self.data[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]

    def order_ids(self) -> np.ndarray:
        """Ids by which 'smaller' is decided; an unknown id is larger than all."""
        return np.where(self.known, self.ids, np.iinfo(np.int64).max)


def rows_of(batches):
    """Rows of Arrow batches as dicts, one at a time (rows are large)."""
    forget()
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}


def bucket_bits(chunks: DataFrame) -> int:
    """log2 of the number of exchange buckets, from the measured text bytes."""
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    return max(6, int(np.ceil(np.log2(max(1, total / BUCKET_BYTES)))))


# ------------------------------------------------------------------ packed keys
KEY_BYTES = 5          # bytes of a key that travel besides the bucket's bits


def planes(a: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of uint64 values, byte plane by byte plane (the
    shuffle's compression then removes the constant planes)."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(b: bytes, width: int) -> np.ndarray:
    a = np.frombuffer(b, dtype=np.uint8).reshape(width, -1)
    out = np.zeros((a.shape[1], 8), dtype=np.uint8)
    out[:, :width] = a.T
    return out.view(U).ravel()


def cut_buckets(keys: np.ndarray, lb: int):
    """(bucket, from, to) of the non-empty hash ranges of ascending 64-bit keys."""
    bounds = np.searchsorted(keys >> U(64 - lb), np.arange((1 << lb) + 1, dtype=U))
    for b in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
        yield b, int(bounds[b]), int(bounds[b + 1])


def key_payload(keys: np.ndarray, lb: int, width: int = KEY_BYTES) -> bytes:
    """Ascending keys of a bucket as differences of their bits below the bucket's."""
    low = keys << U(lb) >> U(64 - 8 * width)
    return planes(np.diff(low, prepend=U(0)), width)


def keys_back(payload: bytes, width: int = KEY_BYTES) -> np.ndarray:
    return np.cumsum(unplanes(payload, width), dtype=U)


REQUEST = "bucket int, chunk long, n int, payload binary"
REPLY = "bucket int, chunk long, n int, bits binary"


def request_batch(chunk: int, parts: list) -> pa.RecordBatch:
    """parts: (bucket, n, payload)"""
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array([p[0] for p in parts], pa.int32()),
        "chunk": pa.array([chunk] * len(parts), pa.int64()),
        "n": pa.array([p[1] for p in parts], pa.int32()),
        "payload": pa.array([p[2] for p in parts], pa.binary())})


def exchange(requests: DataFrame, answer) -> DataFrame:
    """One row (chunk, rep) per chunk: the answers of all buckets. ``answer`` takes
    the payloads of a bucket (list) and returns one uint8 array per payload."""

    def reduce(table):
        bits = answer(table.column("payload").to_pylist())
        return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                         "n": table.column("n"),
                         "bits": pa.array([x.tobytes() for x in bits], pa.binary())})

    replies = requests.groupBy("bucket").applyInArrow(reduce, REPLY)
    return (replies.groupBy("chunk")
            .agg(F.collect_list(F.struct("bucket", "n", "bits")).alias("rep")))


def reply_bits(rep: list | None) -> np.ndarray:
    """Boolean answers of a chunk in the order of its ascending keys."""
    parts = [np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), count=r["n"])
             for r in sorted(rep or [], key=lambda r: r["bucket"])]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, dtype=bool)


def repeated(payloads: list) -> list:
    """Answer: does another payload of the bucket hold the same key?"""
    vals = [keys_back(p) for p in payloads]
    a = np.concatenate(vals)
    order = np.argsort(a, kind="stable")
    s = a[order]
    same = s[1:] == s[:-1]
    f = np.zeros(len(a), dtype=bool)
    f[1:] |= same
    f[:-1] |= same
    out = np.empty(len(a), dtype=bool)
    out[order] = f
    return [np.packbits(x) for x in np.split(out, np.cumsum([len(v) for v in vals])[:-1])]


def first_in_group(inverse: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """For each of n groups the value at its first position."""
    out = np.zeros(n, dtype=values.dtype)
    out[inverse[::-1]] = values[::-1]
    return out
