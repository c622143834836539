"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text becomes a set of hashed features: its words (lower-cased, outer
punctuation removed) and their beginnings, the shape of each word (case, outer
punctuation) and steps of two shares (words equal to the one before, words with a run of punctuation).
One weight per bucket, shared by all grades, gives a score eta; with ordered
thresholds theta_0 < theta_1 < ... P(grade <= k) = sigmoid(theta_k - eta). From
these follow the expected grade and the tail probability P(grade >= cutoff) by
which documents are selected.

The fit maximises the penalised likelihood (L-BFGS) over a bounded sample of the
labelled rows: of the n ratings of an id and grade, n * max_rows / all are drawn (the
fraction by a hash), so about ``max_rows`` are expected however the ratings are
spread, and only their hashed features reach the driver. Scoring is
map-only and reads whole texts; the weights (``buckets`` floats) are broadcast.

Defined cases: NULL and empty texts have no word features and are scored by the
thresholds; labels with a NULL grade or outside 0..grades-1 are left out; several
ratings of one id all count, with one of its texts if the id is repeated; without any usable
rating of a document every document is kept (tail probability 1), and if there are such ratings but
none is drawn, an error is raised; very long texts are read whole, one at a time; other columns are
kept, those named as a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolab.llm.common import annotate, as_bytes, once, ship
from annolab.session import materialize

BUCKETS = 1 << 16
MAX_ROWS = 20_000
GRADES = 3
CUTOFF = 2
KEEP_AT = 0.5
L2 = 0.3
ITERATIONS = 80
ROWS = 1000                # of a block of the fit
SEEN = 1 << 16            # words that a worker looks up, about 40 MB
PREFIXES = (4, 5)         # characters of a word's beginning that are features too
OUTER = bytes(b for b in range(256) if b < 128 and not chr(b).isalnum())


class Features:
    """Hashed features of texts; words seen before are looked up."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.seen = buckets, {}

    def bucket(self, name: bytes) -> int:
        return xxhash.xxh3_64_intdigest(name) % self.buckets

    def word(self, w: bytes) -> tuple:
        got = self.seen.get(w)
        if got is None:
            core = w.strip(OUTER)
            tail = w[len(w.rstrip(OUTER)):] if core else w
            case = b"U" if len(core) > 1 and core == core.upper() != core.lower() else b"l"
            runs = len(tail) > 1
            name = core.decode("utf-8", "replace").lower()
            begins = [self.bucket(b"p" + name[:n].encode()) for n in PREFIXES if len(name) > n]
            got = ((self.bucket(b"w" + name.encode()), *begins, self.bucket(b"s" + case + tail[:4])), runs)
            if len(self.seen) >= SEEN:
                self.seen.clear()
            self.seen[w] = got
        return got

    def of(self, text: bytes | None) -> np.ndarray:
        words = text.split() if text else []
        out, runs = set(), 0
        for w in set(words):
            buckets, r = self.word(w)
            out.update(buckets)
            runs += r
        if words:
            same = sum(map(bytes.__eq__, words, words[1:])) / len(words)
            for name, share in ((b"same", same), (b"runs", runs / len(words))):
                out.update(self.bucket(b"%s>%d" % (name, k)) for k, at in enumerate((0.02, 0.1, 0.3)) if share > at)
        return np.fromiter(out, dtype=np.int64, count=len(out))


class Model:
    """weights (buckets), ascending thresholds (grades - 1)."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def probabilities(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. as columns."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - eta[:, None], -500, 500)))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def loss_and_gradient(params, idx, starts, lens, y, grades, buckets, l2):
    """Penalised negative log likelihood per row; params: weights, first threshold,
    logs of the gaps between thresholds."""
    w, first, gaps = params[:buckets], params[buckets], np.exp(np.clip(params[buckets + 1:], -20, 20))
    theta = np.concatenate([[-np.inf], first + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
    eta = np.zeros(len(y))
    blocks = [(a, min(a + ROWS, len(y))) for a in range(0, len(y), ROWS)]
    for a, b in blocks:                                  # block by block: small temporaries
        some = a + np.flatnonzero(lens[a:b] > 0)
        if len(some):
            first, last = starts[some[0]], starts[some[-1]] + lens[some[-1]]
            eta[some] = np.add.reduceat(w[idx[first:last]], starts[some] - first)
    up, lo = sigmoid(theta[y + 1] - eta), sigmoid(theta[y] - eta)
    p = np.maximum(up - lo, 1e-12)
    d_eta = (1.0 - up - lo) / len(y)
    grad = np.empty_like(params)
    grad[:buckets] = 0.0
    for a, b in blocks:
        part = slice(starts[a], starts[b - 1] + lens[b - 1])
        grad[:buckets] += np.bincount(idx[part], weights=np.repeat(d_eta[a:b], lens[a:b]), minlength=buckets)
    d_theta = np.zeros(grades + 1)
    np.add.at(d_theta, y + 1, -up * (1 - up) / p / len(y))
    np.add.at(d_theta, y, lo * (1 - lo) / p / len(y))
    inner = d_theta[1:grades]
    grad[buckets] = inner.sum()
    grad[buckets + 1:] = [inner[k + 1:].sum() * gaps[k] for k in range(grades - 2)]
    lam = l2 / len(y)
    grad[:buckets] += lam * w
    return -np.log(p).mean() + 0.5 * lam * (w @ w), grad


def minimise(f, x, iterations: int, memory: int = 8):
    """L-BFGS with backtracking."""
    value, g = f(x)
    steps: list = []
    for _ in range(iterations):
        d, kept = -g, []
        for s, y, rho in reversed(steps):
            a = rho * (s @ d)
            kept.append(a)
            d = d - a * y
        if steps:
            s, y, _ = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(steps, reversed(kept)):
            d = d + s * (a - rho * (y @ d))
        t, slope = 1.0, g @ d
        if not steps:
            t = min(1.0, 1.0 / (np.abs(g).sum() + 1e-12))
        for _ in range(30):
            nx = x + t * d
            nv, ng = f(nx)
            if nv <= value + 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = nx - x, ng - g
        if s @ y > 1e-12:
            steps = [*steps[-memory + 1:], (s, y, 1.0 / (s @ y))]
        done = value - nv < 1e-7 * max(1.0, abs(value))
        x, value, g = nx, nv, ng
        if done:
            break
    return x


def fit(docs: DataFrame, ratings: DataFrame, grades: int = GRADES, max_rows: int = MAX_ROWS,
        buckets: int = BUCKETS, l2: float = L2, iterations: int = ITERATIONS) -> Model | None:
    """Fit on about max_rows rated rows of ``ratings`` (doc_id, grade)."""
    ship(docs.sparkSession)
    usable = ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1)).select(
        F.col("doc_id"), F.col("grade").cast("int").alias("grade"))
    n = usable.count()
    if n == 0:
        return None
    # of the ratings of an id and grade, their share as whole rows, the rest by a hash: a document
    # with many ratings gets its share of the draw, not all of it or nothing
    share = min(1.0, max_rows / n)
    by_hash = F.pmod(F.xxhash64("doc_id", "grade"), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = (usable.groupBy("doc_id", "grade").agg(F.count("*").alias("n"))
             .withColumn("rows", F.floor(F.col("n") * F.lit(share) + by_hash).cast("int")).where("rows > 0"))
    drawn = materialize(drawn, "drawn")
    if drawn.count() > 4 * max_rows + 1000:
        raise ValueError(f"{n} ratings gave many more than {max_rows} drawn ids")
    # one text of each drawn id; the ids' number is checked, so they may be broadcast
    texts = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
             .join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"))).alias("text")))
    rated = texts.join(drawn, "doc_id")

    def hashed(batches):
        features = Features(buckets)
        for batch in batches:
            rows = [features.of(t).astype(np.int32).tobytes() for t in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), *batch.columns[1:]],
                                             names=["f", "grade", "h", "rows"])

    rows = (rated.select("text", "grade", F.xxhash64("doc_id", "text").alias("h"), "rows")
            .mapInArrow(hashed, "f binary, grade int, h long, rows int").toArrow())
    order = np.lexsort((rows.column("grade").to_numpy(), rows.column("h").to_numpy()))
    order = np.repeat(order, rows.column("rows").to_numpy()[order])
    y = rows.column("grade").to_numpy()[order].astype(np.int64)
    if len(y) == 0:                                          # none of the drawn ids is in docs
        if texts.isEmpty() and not usable.join(docs.select("doc_id"), "doc_id", "left_semi").isEmpty():
            raise ValueError(f"none of {n} ratings drawn: raise max_rows")
        return None
    sets = rows.column("f").to_pylist()
    lens = np.array([len(sets[i]) // 4 for i in order])
    idx = np.frombuffer(b"".join(sets[i] for i in order), dtype=np.int32)
    del rows, sets
    starts = np.cumsum(lens) - lens
    x = np.zeros(buckets + grades - 1)
    below = np.clip([(y <= k).mean() for k in range(grades - 1)], 0.01, 0.99)
    theta = np.log(below / (1 - below)) + 1e-3 * np.arange(grades - 1)
    x[buckets], x[buckets + 1:] = theta[0], np.log(np.maximum(np.diff(theta), 1e-3))
    x = minimise(lambda p: loss_and_gradient(p, idx, starts, lens, y, grades, buckets, l2), x, iterations)
    gaps = np.exp(np.clip(x[buckets + 1:], -20, 20))
    return Model(x[:buckets].astype(np.float32), x[buckets] + np.concatenate([[0.0], np.cumsum(gaps)]))


def score(docs: DataFrame, model: Model | None, cutoff: int = CUTOFF, keep_at: float = KEEP_AT,
          grades: int = GRADES) -> DataFrame:
    """docs plus expected_grade, p_tail = P(grade >= cutoff) and keep."""
    fields = [T.StructField("expected_grade", T.DoubleType()), T.StructField("p_tail", T.DoubleType()),
              T.StructField("keep", T.BooleanType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        features = once(shared, lambda m: Features(BUCKETS if m is None else len(m.weights)))

        def work(texts):
            if model is None:
                return [[float(grades - 1)] * len(texts), [1.0] * len(texts), [True] * len(texts)]
            eta = np.array([float(model.weights[features.of(t)].sum(dtype=np.float64)) for t in texts])
            p = model.probabilities(eta) if len(texts) else np.zeros((0, grades - 1))
            tail = p[:, cutoff - 1]
            return [p.sum(axis=1), tail, tail >= keep_at]
        return work

    return annotate(docs, fields, start)


def grade_of(quality: str = "quality", toxic: str = "toxic"):
    """The graded rating of the labels table: 0 toxic, 1 of low quality, 2 good."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)
