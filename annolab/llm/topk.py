"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector are dealt to ``lists`` equal blocks; a block's partial
inner products with a query are one score list, the score of a candidate is the
sum over the lists.

1. Every task takes the k best entries of each list for each query, completes
   their scores, and sends the k best. The k-th best score over all tasks, t, is
   a safe cutoff: at least k candidates reach it.
2. t is broadcast. A candidate that reaches t has at least one partial score of
   t / lists or more (the uniform threshold), so only entries at or above it are
   collected.
3. The missing parts of the collected candidates' scores are computed exactly; of
   those that reach t a task returns its k best, and the k best of all follow.

Queries are taken in blocks of ``block`` (a bounded broadcast); every block meets
all candidate rows, map-only, plus one small shuffle by query.

Components are floor(256 * x) with x as a double. Vectors that are NULL, hold a
NULL or non-finite component, or have a NULL id take no part; shorter vectors are
filled up with zeros. Repeated rows of an id: as a candidate an id has its best
score; as a query the first of its vectors in lexicographic order. Ties go to the
smaller id. Scores are exact while they fit 2^53, else computed in int64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolab.llm.common import ship

K = 5
LISTS = 4
BLOCK = 4096
ROWS = 1024
SCHEMA = "query_id long, vec_id long, score long"


def vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v: array<double> of whole numbers), usable rows only."""
    v = F.col(f"`{vec_col}`")
    ok = v.isNotNull() & F.col(f"`{id_col}`").isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(ok).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                               F.transform(v, lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"))


def query_blocks(rows: DataFrame, every: int, block: int):
    """Bounded blocks of (ids, vectors) of the ids divisible by ``every``."""
    q = (rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")))
    ids, vecs = [], []
    for r in q.toLocalIterator():
        ids.append(r["vec_id"])
        vecs.append(r["v"])
        if len(ids) == block:
            yield ids, vecs
            ids, vecs = [], []
    if ids:
        yield ids, vecs


def matrix(vecs: list, width: int) -> np.ndarray:
    out = np.zeros((len(vecs), width))
    for i, v in enumerate(vecs):
        out[i, :len(v)] = v
    return out


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of the given width (longer rows are cut:
    beyond the queries' width the other factor is zero)."""
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lens) and (lens == lens[0]).all():
        m = flat.reshape(len(lens), int(lens[0]))[:, :width]
        return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))
    return matrix([v[:width] for v in np.split(flat, np.cumsum(lens)[:-1])], width)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.size and b.size and a.shape[1] * np.abs(a).max() * np.abs(b).max() >= 2.0 ** 53:
        return (a.astype(np.int64) @ b.astype(np.int64).T)
    return a @ b.T


class Best:
    """The k best (score, id) of each query so far; ids count once."""

    def __init__(self, ids: list, k: int):
        self.ids, self.k, self.rows = ids, k, [dict() for _ in ids]

    def add(self, q: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        order = np.lexsort((vec, -score, q))
        q, vec, score = q[order], vec[order], score[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else []
        for a, b in zip(starts, [*starts[1:], len(q)]):
            have = self.rows[q[a]]
            own, taken = self.ids[q[a]], 0
            for i in range(a, b):
                v, s = int(vec[i]), int(score[i])
                if v == own:
                    continue
                if s > have.get(v, s - 1):
                    taken += v not in have
                    have[v] = s
                if taken > self.k:
                    break
            if len(have) > self.k:
                self.rows[q[a]] = dict(sorted(have.items(), key=lambda e: (-e[1], e[0]))[:self.k])

    def batch(self) -> pa.RecordBatch:
        rows = [(self.ids[q], v, s) for q, have in enumerate(self.rows) for v, s in have.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                          names=["query_id", "vec_id", "score"])


def partials(batch, queries: np.ndarray, lists: int):
    """(ids, candidate rows, partial scores per list) in slices of a batch."""
    width = queries.shape[1]
    cuts = np.linspace(0, width, lists + 1).astype(int)
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        rows = padded(part.column(1), width)
        yield (part.column(0).to_numpy(),
               [product(queries[:, a:b], rows[:, a:b]) for a, b in zip(cuts, cuts[1:])])


def top_k(df: DataFrame, k: int = K, every: int = 50, lists: int = LISTS, block: int = BLOCK,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k best of each query."""
    spark = df.sparkSession
    ship(spark)
    rows = vectors(df, id_col, vec_col)
    found = None
    for ids, vecs in query_blocks(rows, every, block):
        one = _block(rows, ids, matrix(vecs, max(1, max(map(len, vecs)))), k, lists)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], SCHEMA)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _block(rows: DataFrame, ids: list, queries: np.ndarray, k: int, lists: int) -> DataFrame:
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast((ids, queries))

    def heads(batches):                                  # phase 1
        ids, queries = shared.value
        best = Best(ids, k)
        for batch in batches:
            for vec, parts in partials(batch, queries, lists):
                total = sum(parts)
                n = min(k + 1, len(vec))                 # one more: the query's own row
                for p in parts:
                    at = np.argpartition(-p, n - 1, axis=1)[:, :n]
                    q = np.repeat(np.arange(len(ids)), n)
                    best.add(q, vec[at.ravel()], total[q, at.ravel()])
        yield best.batch()

    # the k-th best of each query over all tasks (distinct candidates)
    gathered = (rows.mapInArrow(heads, SCHEMA).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                .groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
                .select("query_id", F.expr(f"IF(size(s) >= {k}, s[{k - 1}], NULL)").alias("t")))
    cutoff = {r["query_id"]: r["t"] for r in gathered.collect()}
    t = np.array([cutoff[i] if cutoff.get(i) is not None else -2.0 ** 62 for i in ids], dtype=np.float64)
    t = np.where(np.abs(t) < 2.0 ** 53, t, t - np.abs(t) * 1e-15)       # never rounded up
    safe = sc.broadcast(t)

    def collect(batches):                                # phases 2 and 3
        ids, queries = shared.value
        t = safe.value
        best = Best(ids, k)
        for batch in batches:
            for vec, parts in partials(batch, queries, lists):
                seen = np.zeros(parts[0].shape, dtype=bool)
                for p in parts:
                    seen |= p >= np.floor(t / lists)[:, None]
                q, row = np.nonzero(seen)
                score = sum(p[q, row] for p in parts)
                on = score >= t[q]
                best.add(q[on], vec[row[on]], score[on])
        yield best.batch()

    return rows.mapInArrow(collect, SCHEMA)
