"""Text embeddings (M04) and their content-addressed cache.

The reference runs a frozen sentence encoder in batches of 32. Here the
encoder is pluggable:

* default: a hashing encoder - each n-gram of the text adds +1 or -1
  (by the md5 of the n-gram) to one of ``embedding_dim`` buckets, and the vector is
  L2-normalised; map-only: tokens by Spark, their n-grams numbered and counted by numpy in
  Arrow batches, each distinct one of a slice hashed once;
* any Python callable ``encode(list[str]) -> np.ndarray[n, d]`` runs in an
  iterator ``mapInPandas``: the encoder is built once per task and fed
  sub-batches of ``batch_size`` texts (Arrow batches in between).

The cache is a Parquet table, partitioned by (model_name, params) - everything that
decides a vector: dimension and n-gram range - and keyed by text_sha; only texts
whose key is missing (left-anti join) are encoded, then appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.functions.text import tokens
from annolab.session import materialize, ship_package

HASHING_MODEL = "hashing-ngrams"
SLICE = 1 << 20            # tokens whose n-grams are numbered together
CACHE = "text_sha string, embedding array<double>, model_name string, params string"


def gram_slots(grams: list, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, sign) of each n-gram: the first 8 hex digits of its md5 modulo dim, and -1 if
    the next digit is odd."""
    h = np.frombuffer(b"".join([hashlib.md5(g, usedforsecurity=False).digest() for g in grams]), dtype=np.uint8).reshape(-1, 16)
    first = np.ascontiguousarray(h[:, :4]).view(">u4").ravel().astype(np.int64)
    return first % dim, np.where(h[:, 4] >> 4 & 1, -1.0, 1.0)


def hashed_counts(tokens: pa.ListArray, dim: int, lo: int, hi: int) -> np.ndarray:
    """Signed hashed n-gram counts, a row per list of tokens. Every distinct n-gram of the
    lists is hashed once."""
    lens = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy().astype(np.int64)
    encoded = tokens.flatten().cast(pa.binary()).dictionary_encode()
    words, code = encoded.dictionary.to_pylist(), encoded.indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(lens)), lens)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(code))       # tokens up to the end of the row
    out = np.zeros(len(lens) * dim)
    grams, at, level = words, code, np.arange(len(code))                 # n-grams by number, and where they begin
    for n in range(1, hi + 1):
        if n > 1:
            more = left[level] >= n
            level, at = level[more], at[more]
            pair, at = np.unique(at * len(words) + code[level + n - 1], return_inverse=True)
            grams = [grams[p] + b" " + words[w] for p, w in zip(*(x.tolist() for x in np.divmod(pair, max(len(words), 1))))]
        if n >= lo and len(level):
            bucket, sign = gram_slots(grams, dim)
            out += np.bincount(row[level] * dim + bucket[at], weights=sign[at], minlength=len(out))
    return out.reshape(len(lens), dim)


def hashing_vectors(tokens: pa.ListArray, dim: int, lo: int, hi: int) -> pa.ListArray:
    """L2-normalised hashed counts of lists of tokens, ``SLICE`` tokens or one row at a time."""
    lens = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
    ends, parts, at = np.cumsum(lens), [np.zeros((0, dim))], 0
    while at < len(lens):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        v = hashed_counts(tokens.slice(at, to - at), dim, lo, hi)
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        parts.append(v / np.where(norm > 0, norm, 1.0))
        at = to
    flat = np.concatenate(parts)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * dim, pa.int32()), pa.array(flat.ravel()))


def hashing_embed(df: DataFrame, text: str = "text", out: str = "embedding",
                  settings: Settings = DEFAULTS) -> DataFrame:
    """Signed hashed n-gram counts, L2-normalised (a text without n-grams: zeros). The
    encoder is marked as not deterministic, so that no filter over its vector or its
    elements repeats it."""
    ship_package(df.sparkSession)
    dim, (lo, hi) = settings.embedding_dim, settings.ngram_range

    def encode(t: pa.Array) -> pa.Array:
        return hashing_vectors(t, dim, lo, hi)

    vectors = F.arrow_udf(encode, "array<double>").asNondeterministic()
    return df.withColumn(out, vectors(tokens(text)))


def python_embed(df: DataFrame, encoder_factory: Callable[[], Callable[[list[str]], np.ndarray]],
                 dim: int, text: str = "text", key: str = "text_sha",
                 batch_size: int = DEFAULTS.batch_size) -> DataFrame:
    """Run a Python encoder in Arrow batches; returns (key, embedding)."""
    def run(batches):
        encode = encoder_factory()           # loaded once per task
        for pdf in batches:
            texts = pdf[text].fillna("").tolist()
            vecs = []
            for i in range(0, len(texts), batch_size):
                vecs.append(np.asarray(encode(texts[i:i + batch_size]), dtype=np.float64).reshape(-1, dim))
            arr = np.concatenate(vecs) if vecs else np.zeros((0, dim))
            yield pd.DataFrame({key: pdf[key], "embedding": list(arr)})
    return df.select(key, text).mapInPandas(run, schema=f"{key} string, embedding array<double>")


def text_key(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table; empty when the path does not exist (any other failure shows)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
    return spark.read.schema(CACHE).parquet(path) if there else spark.createDataFrame([], CACHE)


def missing_texts(df: DataFrame, cache_path: str, params: str, text: str = "text",
                  model_name: str = HASHING_MODEL) -> DataFrame:
    """(text_sha, text) of the distinct texts that the cache lacks."""
    have = read_cache(df.sparkSession, cache_path).filter(
        (F.col("model_name") == model_name) & (F.col("params") == params)).select("text_sha")
    distinct = df.select(text_key(text).alias("text_sha"), text).dropDuplicates(["text_sha"])
    return distinct.join(have, "text_sha", "left_anti")


def params_of(dim: int, settings: Settings = DEFAULTS) -> str:
    lo, hi = settings.ngram_range
    return f"dim={dim},ngrams={lo}-{hi}"


def cached_embed(df: DataFrame, cache_path: str | None, text: str = "text",
                 model_name: str = HASHING_MODEL, settings: Settings = DEFAULTS,
                 encoder_factory=None, dim: int | None = None) -> DataFrame:
    """Add ``embedding`` to every row of df, encoding each distinct text once
    and only when the cache lacks it (S08)."""
    spark, dim = df.sparkSession, dim or settings.embedding_dim
    params = params_of(dim, settings)
    keyed = df.withColumn("text_sha", text_key(text))
    if cache_path:
        missing = materialize(missing_texts(df, cache_path, params, text, model_name), "missing")
    else:
        missing = keyed.select("text_sha", text).dropDuplicates(["text_sha"])
    if encoder_factory is None:
        fresh = hashing_embed(missing, text, "embedding", settings).select("text_sha", "embedding")
    else:
        fresh = python_embed(missing, encoder_factory, dim, text)
    if cache_path:
        (fresh.withColumn("model_name", F.lit(model_name)).withColumn("params", F.lit(params))
         .write.mode("append").partitionBy("model_name", "params").parquet(cache_path))
        fresh = (read_cache(spark, cache_path)
                 .filter((F.col("model_name") == model_name) & (F.col("params") == params))
                 .select("text_sha", "embedding").dropDuplicates(["text_sha"]))
    return keyed.join(fresh, "text_sha").drop("text_sha")
