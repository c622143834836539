"""op11, op12 and op13 against their brute-force versions: NULLs, empty and very long texts,
ties, repeated rows, empty tables, extra columns with clashing names, small parameters that
send everything through the later stages."""

import random

import numpy as np
import pytest

from annolab.llm import alignment, periodic, vectors

WORDS = "the of it's naïve 日本語 we'll 42 don't end. (x) é résumé 🙂 <s> </s> <unk> <|endoftext|> <0x0A>".split()


def odd_texts():
    return [(1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "\t\r\n "), (None, "hello"), (7, "é    z\n\n\nb \n c"),
            (8, "x" * 3000), (9, "\nab\n"), (10, "a "), (2, "the the"), (2, "the the"), (11, "​a\x1cb c　d")]


def word_texts(seed, n):
    r = random.Random(seed)
    return [(100 + i, "".join(r.choice(WORDS) + r.choice([" ", " ", "\n", "  "]) for _ in range(r.randint(0, 60))))
            for i in range(n)]


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 30, 0])
def test_alignment(spark, heavy):
    docs = odd_texts() + word_texts(heavy, 40)
    df = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in docs], "doc_id long, text string, n_a int, pair string, at int")
    got = alignment.link_statistics(df.repartition(3), heavy=heavy)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(alignment.brute_force(docs), key=str)
    assert alignment.link_statistics(df.limit(0)).collect() == []


def test_alignment_outputs(spark):
    """The groups tile the text: both sides of a group spell the same bytes."""
    docs = word_texts(3, 20)
    tool = alignment.Aligner((alignment.read_file(alignment.A_FILE), alignment.read_file(alignment.B_FILE)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for row in alignment.alignments(df).collect():
        spelt = [{}, {}]
        for side, ids, groups, text in ((0, row.a_ids, row.a_group, tool.a.text), (1, row.b_ids, row.b_group, tool.b.text)):
            for i, g in zip(ids, groups):
                spelt[side][g] = spelt[side].get(g, b"") + text[i]
        assert spelt[0] == spelt[1]
        text = dict(docs)[row.doc_id]
        assert b"".join(spelt[0].values()).decode() == (" " + text if text else "")


def test_distinct_is_unique():
    r = np.random.default_rng(1)
    for codes, limit in ((r.integers(0, 50, 400), 50), (r.integers(0, 1 << 61, 9), 1 << 62), (np.zeros(0, dtype=np.int64), 9)):
        for x, y in zip(alignment.distinct(codes, limit), np.unique(codes, return_inverse=True, return_counts=True)):
            assert np.array_equal(x, y)


def periodic_texts(seed):
    r = random.Random(seed)
    docs = []
    for i in range(60):
        letters = "abc"[:r.randint(1, 3)] if r.random() < 0.6 else "abcdefgh"
        w = []
        for _ in range(r.randint(0, 6)):
            v = [r.choice(letters) for _ in range(r.randint(1, 14))]
            u = v * r.randint(1, 8)
            w += u[:max(1, len(u) - r.randint(0, len(v)))] if r.random() < 0.7 else r.choices(letters, k=r.randint(1, 20))
        docs.append((r.randint(-99, 10 ** 6) if i else None, " ".join(w[:170])))
    return docs + [(5, None), (6, ""), (7, "a"), (8, "a\n" * 6), (8, "a\n" * 6), (9, " \t")]


@pytest.mark.parametrize("seed", range(6))
def test_periodic_rows(seed):
    docs, rewrite = periodic_texts(seed), periodic.planted if seed % 2 else None
    got = periodic.analyse([i for i, _ in docs], [None if t is None else t.encode() for _, t in docs], rewrite)
    for g, (i, runs, kept), (_, t) in zip(got, periodic.brute_force(docs, rewrite), docs):
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        assert g[:3] == (i, len((t or "").split()), len(runs))
        assert g[3:7] == (None,) * 4 if top is None else g[3:7] == (*top, 1000 * top[1] // top[2])
        assert g[7].decode() == "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert g[8] == b" ".join(kept)


def test_periodic_query(spark):
    docs = periodic_texts(9)
    df = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id long, text string, start int, runs string")
    got = periodic.digest(periodic.periodic_runs(df.repartition(3))).collect()
    want = periodic.digest(spark.createDataFrame(
        [tuple(r) for r in periodic.analyse([i for i, _ in docs], [None if t is None else t.encode() for _, t in docs])],
        periodic.RESULT)).collect()
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(df.limit(0)).collect() == []


def test_periodic_long_texts():
    """A million words: one long run, and runs without number."""
    one = periodic.analyse([1], [b"x " + b"a b c " * 300_000], None)[0]
    assert one[2:6] == (1, 1, 900_000, 3) and one[8] == b"x a b c"
    many = periodic.analyse([1], [b"a a a a a a b c " * 100_000], None)[0]
    assert many[2] == 100_001 and many[3:6] == (0, 800_000, 8)


def vector_rows(seed, n, dim=8):
    r = np.random.default_rng(seed)
    rows, middle = [], r.normal(size=(6, dim))
    for i in range(n):
        k = r.random()
        if k < 0.35:                                         # a third of all rows near one point
            v = middle[0] + r.normal(size=dim) * 0.05
        elif k < 0.7:
            v = middle[r.integers(6)] + r.normal(size=dim) * r.choice([0.02, 0.1, 0.2])
        elif k < 0.8 and rows:
            v = np.array(rows[r.integers(len(rows))][1])
        else:
            v = r.normal(size=dim)
        rows.append((int(i * 7 % n), [float(x) for x in v], 0 if r.random() < 0.6 else int(r.integers(3))))
    one = rows[0][1]
    return rows + [rows[1], (None, one, 0), (n + 1, None, 0), (n + 2, [0.0] * dim, 0), (n + 3, [float("nan")] + one[1:], 0),
                   (n + 4, [None] + one[1:], 0), (n + 5, [], 0), (n + 6, one, None), (n + 7, [1.0], 0), (n + 8, [2.0], 0),
                   (n + 9, [1e300] * dim, 1), (n + 10, [1e300] * dim, 1), (n + 11, [float("inf")] * dim, 1)]


@pytest.mark.parametrize("seed,n,small", [
    (1, 250, {}), (2, 500, dict(cell=20, pivots=4, sample=60, block=16)), (4, 400, dict(cell=5, pivots=3, sample=20, block=7))])
def test_near_vectors(spark, seed, n, small):
    rows = vector_rows(seed, n)
    df = spark.createDataFrame([(*r, True, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept boolean, cell string")
    got = vectors.near_vectors(df.repartition(4), **small)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(vectors.brute_force(rows), key=str)


def test_near_vectors_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(df).collect() == []
