"""op7, op8 and op9 against their brute-force versions on small texts with copies,
near copies, shared passages, NULLs, empty and periodic texts."""

import random

import pytest

import corpus_pipeline
from annolab.llm import debruijn, minhash, parsing

SCHEMA = "doc_id long, text string, spans string, chunk long"


def texts(seed, n=60, vocabulary=40):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 7))) for _ in range(vocabulary)]
    passages = [" ".join(r.choices(words, k=r.randint(10, 40))) for _ in range(4)]
    out = []
    for _ in range(n):
        kind = r.random()
        t = " ".join(r.choices(words, k=r.randint(0, 80)))
        if kind < 0.25 and out:
            t = r.choice(out)
        elif kind < 0.5 and out:
            w = r.choice(out).split()
            if w:
                w[r.randrange(len(w))] = r.choice(words)
            t = " ".join(w)
        elif kind < 0.7:
            t = t + " " + r.choice(passages) + "\n" + " ".join(r.choices(words, k=20))
        elif kind < 0.75:
            t = "ab " * r.randint(1, 90)
        elif kind < 0.8:
            t = "-" * r.randint(1, 200)
        out.append(t)
    return out


def rows(seed):
    r = random.Random(seed + 100)
    docs = list(enumerate(texts(seed)))
    r.shuffle(docs)
    docs += [(1000, None), (1001, ""), (1002, "one"), (1003, " \n\t"), (None, docs[0][1]), (None, None)]
    docs.append(docs[3])                                     # a repeated row
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in docs], SCHEMA).repartition(3)


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r))


@pytest.mark.parametrize("seed", [1, 2])
def test_word_windows(spark, monkeypatch, seed):
    monkeypatch.setattr(debruijn.C, "CHUNK_DOCS", 9)
    docs = rows(seed)
    got = debruijn.dedup(frame(spark, docs)).collect()
    want = debruijn.brute_force(docs)
    assert any(r[2] for r in want)
    assert key((r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in got) == key(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_byte_strings(spark, monkeypatch, seed):
    monkeypatch.setattr(parsing.C, "CHUNK_DOCS", 9)
    docs = rows(seed)
    got = parsing.dedup(frame(spark, docs)).collect()
    want = parsing.brute_force(docs)
    assert any(r[2] for r in want)
    assert key((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == key(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, monkeypatch, seed):
    monkeypatch.setattr(minhash, "BLOCK", 200)               # families of several blocks
    docs = rows(seed)
    got = minhash.near_duplicates(frame(spark, docs)).collect()
    known = {i: t for i, t in docs if i is not None}
    want = minhash.brute_force(list(known.items()))
    assert len(got) == len(docs)
    assert len({want[i][1] for i in want}) < len(want)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_hot_list(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LIST", 5)                  # lists joined as stars
    docs = [(i, "a b c d e f g h i j k l m n o p q r s t u v w x y z %d" % (i % 7)) for i in range(60)]
    got = minhash.near_duplicates(frame(spark, docs)).collect()
    want = minhash.brute_force(docs)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)


@pytest.mark.parametrize("dedup", [debruijn.dedup, parsing.dedup, minhash.near_duplicates])
def test_empty_table(spark, dedup):
    assert dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_shingle_and_need_are_parameters(spark, monkeypatch, seed):
    monkeypatch.setattr(minhash, "BLOCK", 200)
    docs = rows(seed)
    known = {i: t for i, t in docs if i is not None}
    want = minhash.brute_force(list(known.items()), 5, 80)
    got = [r for r in minhash.near_duplicates(frame(spark, docs), 5, 80).collect() if r.doc_id is not None]
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got)


def test_matches_for():
    assert minhash.matches_for(85) == 7 and minhash.matches_for(80) == 5
    with pytest.raises(ValueError):
        minhash.matches_for(40)


def test_pipeline_stage_finds_an_appended_passage(spark):
    r = random.Random(5)
    w = ["".join(r.choices("abcdefghij", k=8)) for _ in range(485)]
    pairs = [(1, " ".join(w[:400])), (2, " ".join(w)), (3, " ".join(reversed(w)))]
    sets = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for _, t in pairs]
    assert 0.82 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.83
    docs = spark.createDataFrame([(i, t, "x") for i, t in pairs], "doc_id long, text string, lang string")
    assert sorted(x.doc_id for x in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()) == [1, 3]
