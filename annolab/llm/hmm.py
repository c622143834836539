"""LM scoring with a hidden Markov language model.

Tokens: words (A-Z lower-cased, cut at ASCII white space), then one end per text.

Vocabulary. Every training word is counted (a shuffle by word; each task sums its
own words first). The most frequent words have a symbol of their own, all others
share symbols by a hash of their ending; inside a shared symbol a word has
P(word | symbol) = (c + a) / (N_s + a (V_s + 1)), with the remaining a for words
never seen. So the model gives every text a proper probability.

Training. Baum-Welch over the symbol sequences of all training texts: every task
returns its expected counts (states x symbols, transitions, starts), Spark sums
them, the driver normalises (K x M numbers, whatever the corpus). Scoring is the
scaled forward recursion over the whole text; the sum of the logs of the scales
is the exact log-likelihood. Many texts advance at once as lanes, sorted by length.
For training (not for scoring) a text of over ``TOKENS`` words is several sequences.

Counts of words. The ``heavy`` most frequent words (a bounded number) are broadcast
with their counts, so hot words are never shuffled; the other words of a text meet
their counts in a join and come back as one sum per text.

Defined cases: NULL text is empty (one token, the end); a NULL id is scored but not
learned from and not held out; without training texts all words are unseen and the
model is uniform; repeated rows count as often as they occur and are scored alike;
other columns are left out.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.llm import common as C

ADD = 0.1                 # added to each count
STATES = 12
OWN = 1500                # words with a symbol of their own
ENDINGS = 1024            # shared symbols
HEAVY = 200_000           # words broadcast with their counts
ITERATIONS = 5
TOKENS = 400_000          # of a batch of lanes
SCALED = 8                # steps from scaling to scaling
BLOCK = 1 << 16           # tokens summed at once
FLUSH = 300_000           # distinct words a task holds while counting
SEQUENCES = ("row long, doc_id long, held_out boolean, train boolean, n_tokens long, n_known long, "
             "log_heavy double, log_inside double, symbols binary, tail array<binary>")


def words(text: bytes | None) -> list:
    return text.translate(C.LOWER).split() if text else []


def ending(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word[-3:]) % ENDINGS


def count_words(batches):
    have: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(have.keys()), pa.binary()),
                                           pa.array(list(have.values()), pa.int64())], names=["word", "c"])

    for batch in batches:
        for text in C.as_bytes(batch.column(0)):
            have.update(words(text))
            if len(have) > FLUSH:
                yield out()
                have.clear()
    yield out()


def symbol_totals(own: set):
    def run(batches):
        n, v = Counter(), Counter()
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word not in own:
                    e = ending(word)
                    n[e] += c
                    v[e] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array([n[e] for e in n], pa.int64()),
                                          pa.array([v[e] for e in n], pa.int64())], names=["e", "n", "v"])
    return run


class Vocabulary:
    """Totals, the words with own symbols and the heavy words with their counts.
    Symbols: 0 end, 1..OWN own words, then the endings."""

    def __init__(self, heavy: list, counts: np.ndarray, total: int, distinct: int, ends: int,
                 inside_n: np.ndarray, inside_v: np.ndarray):
        self.heavy, self.counts = heavy, counts
        self.total, self.distinct, self.ends = total, distinct, ends
        self.own = min(OWN, len(heavy))
        self.symbols = 1 + self.own + ENDINGS
        self.inside = np.log10(inside_n + ADD * (inside_v + 1))
        self.logs = np.log10(counts + ADD)

    def index(self):
        self.at = {w: i for i, w in enumerate(self.heavy)}
        self.symbol = np.array([1 + i if i < self.own else 1 + self.own + ending(w)
                                for i, w in enumerate(self.heavy)], dtype=np.int64)
        return self


def learn_words(s: C.Scratch, train: DataFrame, heavy: int = HEAVY) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary and the table (word, c) of all training words."""
    counts = s.table(train.select("text").mapInArrow(count_words, "word binary, c long")
                     .groupBy("word").agg(F.sum("c").alias("c")), "counts")
    t = counts.agg(F.sum("c"), F.count("*")).first()
    ends = train.count()
    total, distinct = int(t[0] or 0) + ends, int(t[1]) + (ends > 0)
    # the largest set of words by count (in steps of 1/8 power of two) of at most `heavy` words
    steps = sorted(((r["step"], r["n"]) for r in counts.groupBy(
        F.floor(F.log2(F.col("c").cast("double")) * 8).alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    floor, size = None, 0
    for step, n in steps:
        if size + n > heavy:
            break
        floor, size = step, size + n
    top, c = [], np.zeros(0)
    if floor is not None:
        rows = counts.where(F.floor(F.log2(F.col("c").cast("double")) * 8) >= floor).toArrow()
        pairs = sorted(zip(rows.column("word").to_pylist(), rows.column("c").to_pylist()), key=lambda p: (-p[1], p[0]))
        top, c = [p[0] for p in pairs], np.array([p[1] for p in pairs], dtype=np.float64)
    n, v = np.zeros(ENDINGS), np.zeros(ENDINGS)
    for r in (counts.mapInArrow(symbol_totals(set(top[:OWN])), "e int, n long, v long")
              .groupBy("e").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()):
        n[r["e"]], v[r["e"]] = r["n"], r["v"]
    return Vocabulary(top, c, total, distinct, ends, n, v), counts


def sequence(shared):
    def run(batches):
        voc = C.once(shared, lambda v: v.index())
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                out = []
                for text in C.as_bytes(part.column(3)):
                    w = words(text)
                    idx = np.fromiter((voc.at.get(x, -1) for x in w), dtype=np.int64, count=len(w))
                    seen = idx >= 0
                    tail = [w[i] for i in np.flatnonzero(~seen).tolist()]
                    sym = np.zeros(len(w) + 1, dtype=np.uint16)
                    sym[:-1][seen] = voc.symbol[idx[seen]]
                    sym[:-1][~seen] = [1 + voc.own + ending(x) for x in tail]
                    shared_sym = sym[:-1][sym[:-1] > voc.own].astype(np.int64) - 1 - voc.own
                    heavy = idx[seen]
                    out.append((len(w) + 1, len(heavy) + (voc.ends > 0), float(voc.logs[heavy].sum()),
                                float(voc.logs[heavy[heavy >= voc.own]].sum() - voc.inside[shared_sym].sum()),
                                sym.tobytes(), tail))
                cols = list(zip(*out))
                row = np.arange(k, k + part.num_rows) + base
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), *part.columns[:3], *[pa.array(c, t) for c, t in zip(cols, (
                        pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary())))]],
                    names=["row", "doc_id", "held_out", "train", "n_tokens", "n_known", "log_heavy",
                           "log_inside", "symbols", "tail"])
            base += batch.num_rows
    return run


# ------------------------------------------------------------------ the model
class Model:
    """start (K), move (K x K), emit (K x M)."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def initial(symbols: int, frequency: np.ndarray, states: int, seed: int = 5) -> "Model":
        r = np.random.default_rng(seed)
        emit = (frequency + 1e-6)[None, :] * r.exponential(size=(states, symbols))
        move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
        return Model(np.full(states, 1.0 / states), move / move.sum(1, keepdims=True),
                     emit / emit.sum(1, keepdims=True))


def lanes(seqs: list):
    """Sequences as columns by descending length: (order, symbols by step, active lanes by step)."""
    lens = np.array([len(s) for s in seqs])
    order = np.argsort(-lens, kind="stable")
    active = np.searchsorted(-lens[order], -np.arange(lens.max()), side="left")     # lanes longer than t
    grid = np.zeros((int(lens.max()), len(seqs)), dtype=np.uint16)
    for lane, i in enumerate(order.tolist()):
        grid[:lens[i], lane] = seqs[i]
    return order, grid, active


def steps_of(grid, active):
    """Symbols of all lanes in the order of the steps; the place of each step's first."""
    at = np.concatenate([[0], np.cumsum(active)])
    sym = np.concatenate([grid[t, :n] for t, n in enumerate(active.tolist())])
    return sym, at.tolist()


def forward(m: Model, grid, active, keep: bool):
    """Log10 likelihood per lane; with ``keep`` also the places and symbols, and emissions, scaled
    states and scales by step and lane. States are scaled at every ``SCALED``-th step and where a lane ends: a double holds the product of
    some steps."""
    sym, at = steps_of(grid, active)
    emit = np.ascontiguousarray(m.emit.T).take(sym, axis=0)
    alpha, scale = np.empty_like(emit), np.ones(len(sym))
    total = np.zeros(at[1])
    for t in range(len(at) - 1):
        a, b = at[t], at[t + 1]
        now = alpha[a:b]
        if t:
            np.matmul(alpha[at[t - 1]:at[t - 1] + b - a], m.move, out=now)
            now *= emit[a:b]
        else:
            np.multiply(m.start, emit[a:b], out=now)
        low = _scaled(at, t)
        if low < b:
            c = now[low - a:].sum(axis=1)
            now[low - a:] /= c[:, None]
            scale[low:b] = c
            total[low - a:b - a] += np.log10(c)
    return total, (sym, at) if keep else None, (emit, alpha, scale) if keep else None


def _scaled(at: list, t: int) -> int:
    """The place from which on the lanes of a step are scaled."""
    if t % SCALED == SCALED - 1:
        return at[t]
    return at[t] + (at[t + 2] - at[t + 1] if t + 2 < len(at) else 0)


def expected(m: Model, seqs: list):
    """Expected starts, transitions and emissions of the sequences (Baum-Welch)."""
    _, grid, active = lanes(seqs)
    total, (sym, at), (emit, alpha, scale) = forward(m, grid, active, True)
    k, n = len(m.start), len(sym)
    beta, back = np.ones_like(alpha), np.ascontiguousarray(m.move.T)
    for t in range(len(at) - 2, 0, -1):
        a, b = at[t], at[t + 1]
        w = emit[a:b]                                        # becomes what the step sends back
        w *= beta[a:b]
        low = _scaled(at, t)
        if low < b:
            emit[low:b] /= scale[low:b, None]
        np.matmul(w, back, out=beta[at[t - 1]:at[t - 1] + b - a])
    # each token after the first of its lane, and the one before it
    size = np.diff(at)
    before = np.arange(at[1], n) - np.repeat(size[:-1], size[1:])
    move = np.zeros((k, k))
    for i in range(0, len(before), BLOCK):
        move += alpha.take(before[i:i + BLOCK], axis=0).T @ emit[at[1] + i:at[1] + i + BLOCK]
    alpha *= beta                                            # now the states' probabilities
    start = alpha[:at[1]].sum(axis=0)
    out = np.zeros_like(m.emit)
    order = np.argsort(sym, kind="stable")
    for i in range(0, n, BLOCK):
        own = order[i:i + BLOCK]
        heads = np.flatnonzero(np.r_[True, np.diff(sym[own]) != 0])
        out[:, sym[own[heads]]] += np.add.reduceat(alpha.take(own, axis=0), heads, axis=0).T
    return start, move * m.move, out, float(total.sum())


def batched(batches, at: int):
    """Symbol sequences (with their Arrow rows) in batches of similar length."""
    rows, size = [], 0
    for batch in batches:
        for i, b in enumerate(batch.column(at).to_pylist()):
            rows.append((np.frombuffer(b, dtype=np.uint16), batch, i))
            size += len(b) // 2
        if size > 4 * TOKENS:
            yield from by_length(rows)
            rows, size = [], 0
    if rows:
        yield from by_length(rows)


def by_length(rows: list):
    rows.sort(key=lambda r: len(r[0]))
    part, size = [], 0
    for r in rows:
        if part and (size + len(r[0]) > TOKENS or len(part) * len(r[0]) > 8 * TOKENS):
            yield part
            part, size = [], 0
        part.append(r)
        size += len(r[0])
    if part:
        yield part


def e_step(shared):
    def run(batches):
        m = shared.value
        sums = None
        for part in batched(batches, 0):
            got = expected(m, [r[0][i:i + TOKENS] for r in part for i in range(0, len(r[0]), TOKENS)])
            sums = got if sums is None else tuple(a + b for a, b in zip(sums, got))
        if sums is not None:
            flat = np.concatenate([sums[0], sums[1].ravel(), sums[2].ravel(), [sums[3]]])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at])], names=["i", "v"])
    return run


def train(sequences: DataFrame, vocabulary: Vocabulary, states: int = STATES,
          iterations: int = ITERATIONS) -> Model:
    """Baum-Welch; expected counts are summed by Spark, one row per parameter."""
    sc, m = sequences.sparkSession.sparkContext, vocabulary.symbols
    frequency = np.zeros(m)
    frequency[0] = vocabulary.ends
    frequency[1:1 + vocabulary.own] = vocabulary.counts[:vocabulary.own]
    frequency[1 + vocabulary.own:] = 10.0 ** vocabulary.inside
    frequency /= frequency.sum()
    model = Model.initial(m, frequency, states)
    learned = sequences.where("train").select("symbols")
    for _ in range(iterations if vocabulary.ends else 0):
        shared = sc.broadcast(model)
        rows = (learned.mapInArrow(e_step(shared), "i long, v double")
                .groupBy("i").agg(F.sum("v").alias("v")).toArrow())
        shared.unpersist()
        flat = np.zeros(states + states * states + states * m + 1)
        flat[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
        start = flat[:states] + 1e-3
        move = flat[states:states + states * states].reshape(states, states) + 1e-3
        emit = flat[states + states * states:-1].reshape(states, m) + 0.05 * frequency[None, :] + 1e-8
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    return model


def forward_scores(shared):
    def run(batches):
        m = shared.value
        for part in batched(batches, 1):
            order, grid, active = lanes([r[0] for r in part])
            total, _, _ = forward(m, grid, active, False)
            rows = [part[i] for i in order.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[1].column(0)[r[2]].as_py() for r in rows], pa.int64()),
                                              pa.array(total)], names=["row", "log_hmm"])
    return run


def score(docs: DataFrame, folds: int = 10, states: int = STATES, iterations: int = ITERATIONS,
          heavy: int = HEAVY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    C.ship(spark)
    s = C.Scratch(spark, "hmm")
    fold = C.crc_mod("doc_id", folds)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
                       F.coalesce(fold != 0, F.lit(False)).alias("train"),
                       F.col("text").cast("string").alias("text"))
    vocabulary, counts = learn_words(s, base.where("train").select("text"), heavy)
    shared = spark.sparkContext.broadcast(vocabulary)
    seqs = s.table(base.mapInArrow(sequence(shared), SEQUENCES), "sequences")
    model = train(seqs, vocabulary, states, iterations)

    # words outside the broadcast meet their counts; one sum per text comes back
    rare = seqs.select("row", F.explode("tail").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    tail = (rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + ADD)).alias("log_tail"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_tail")))
    trained = spark.sparkContext.broadcast(model)
    hmm = seqs.select("row", "symbols").mapInArrow(forward_scores(trained), "row long, log_hmm double")
    v = vocabulary
    per_token = float(np.log10(v.total + ADD * (v.distinct + 1)))
    log_end = float(np.log10(v.ends + ADD))
    tail_sum = F.coalesce("log_tail", F.lit(0.0))
    out = seqs.drop("symbols", "tail").join(hmm, "row").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known_tail", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("log_heavy") + tail_sum + log_end - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("log_hmm") + F.col("log_inside") + tail_sum).alias("score"))
    result = s.result(out)
    shared.unpersist()
    trained.unpersist()
    return result
