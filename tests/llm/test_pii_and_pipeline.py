"""op2 against regular expressions written as in the contract; the pipeline stage by
stage against brute force, each on its own input."""

import hashlib
import re

import pytest


import corpus_pipeline
from pyspark.sql import functions as F

from annolab.session import materialize
from annolab.llm import decontaminate, minhash, pieces, pii, quality, queries

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def good(kind, t):
    d = re.sub("[^0-9]", "", t)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in t.split(".")),
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m.group())]


TEXTS = [
    None, "", "no data here", "mail a.b@c.de, x@y", "a@b.c_d@e.f", "a@b.cd@e.f.", "@@ a@b@c.de", "é🙂 ü@x.yy a@x.yy ñ 10.0.0.1",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 or 01.002.0003.4 0.0.0.0 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111111111111111 4111111111111111", "5500-0000-0000-0004x", "+1 (555) 555-1234 +12 +1234567890123456 +1 2", "+1 (2) ) 3  4567890) z",
    "1" * 300, "9 " * 400, "a" * 5000 + "@", "+" * 200 + "1" * 10 + " +44 20 7946 0958.", "call (212) 555-0199 today, order no. (212) 555-0199",
    "visa card 4465758382889430 x 4465 7583 8288 9430", "write joe [at] example (dot) com or ann(at)mail.org", "host 10[.]0[.]0[.]1",
    "tel 212-555-0199 tel 212-555-0198", "4012888888881881,+33 1 23 45 67 89;8.8.8.8 z@z.zz" * 30,
]


def test_base_spans(spark):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[3]), (3, TEXTS[3])]
    df = spark.createDataFrame([(i, t, "old", "kept") for i, t in rows], "doc_id long, text string, base string, note string")
    found = pii.find(df)
    assert found.columns == ["doc_id", "text", "note", "base", "spans"]
    out = found.collect()
    assert len(out) == len(rows)
    for r in out:
        want = base_spans(r.text)
        assert [tuple(s) for s in r.base] == want, r.text
        order = {k: i for i, k in enumerate(pii.KINDS)}
        spans = [tuple(s) for s in r.spans]
        assert set(want) <= set(spans) and spans == sorted(spans, key=lambda s: (order[s[0]], s[1]))
        for k, a, b in set(spans) - set(want):              # added spans overlap no base span
            assert all(b <= x or y <= a for _, x, y in want)
    for r in pii.digest(found).collect():
        assert r.base_sha256 in {hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t)).encode()).hexdigest() for t in TEXTS}


def test_the_method_adds_spans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 4)], "doc_id long, text string")
    added = {(r.text[s.start:s.end]) for r in pii.find(df).collect() for s in r.spans
             if (s.kind, s.start, s.end) not in base_spans(r.text)}
    assert "(212) 555-0199" in added or "212-555-0199" in added


def test_expectation_maximisation_finds_the_good_labelers():
    import random
    r = random.Random(1)
    counts: dict = {}
    for _ in range(4000):
        y = r.random() < 0.6
        v = tuple(int(y) if r.random() < q else int(not y) for q in (0.95, 0.9, 0.85, 0.5, 0.8))
        counts[v] = counts.get(v, 0) + 1
    _, rates = pii.expectation_maximisation(counts)
    assert rates["strict"][0] > 0.9 and rates["strict"][1] < 0.1 and abs(rates["shape"][0] - 0.5) < 0.1


def test_no_candidates_and_empty(spark):
    df = spark.createDataFrame([(1, "nothing"), (2, None)], "doc_id long, text string")
    assert all(r.spans == [] for r in pii.find(df).collect())
    assert pii.find(df.limit(0)).collect() == []


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é a@b.cd +1 (555) 555-1234!"), (2, None), (3, ""), (4, "plain")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "é [EMAIL] [PHONE]!", 2: None, 3: "", 4: "plain"}


# ------------------------------------------------------------------ pipeline
EXTRA = [(9001, None, "en", "src1", 0), (9002, "", "en", "src1", 0), (None, "a b c d", "en", "src2", 7),
         (9003, "mail me at jo@example.org please", "en", "src3", 32)]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(EXTRA, docs.schema)).unionByName(docs.limit(3))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return out


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is None, i or 0))


def test_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "pieces"]
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    assert steps[-1].columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


def test_quality_stage(spark, steps):
    rated = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", quality.grade_of().alias("grade"))
    kept = set(ids(steps[1]))
    grades = {r.doc_id: r.grade for r in rated.collect()}
    assert all((g == 2) == (i in kept) for i, g in grades.items() if i in set(ids(steps[0])))


def test_near_duplicate_stage(steps):
    before = {r.doc_id: r.text for r in steps[1].collect() if r.doc_id is not None}
    rows = list(before.items())
    want = [minhash.brute_force(rows, shingle, need) for shingle, need in corpus_pipeline.LINKS]
    keep = {i for i in before if all(w[i][1] == i for w in want)}
    assert {i for i in ids(steps[2]) if i is not None} == keep and len(keep) < len(before)
    assert ids(steps[2]).count(None) == ids(steps[1]).count(None)


def test_decontamination_stage(spark, steps):
    rows = steps[2].collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = decontaminate.brute_force([r.text for r in rows], items)
    clean = [r.doc_id for k, r in enumerate(rows) if want[k][1] == 0]
    assert ids(steps[3]) == sorted(clean, key=lambda i: (i is None, i or 0))


def test_pii_stage(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    after = steps[4].collect()
    assert len(after) == steps[3].count()
    for r in after:
        assert base_spans(r.text) == [] and (r.text is None) == (before[r.doc_id] is None)
        if r.text is not None:
            assert r.n_chars == len(r.text)
            if not base_spans(before[r.doc_id]):
                assert "[EMAIL]" not in r.text
    assert any("[EMAIL]" in (r.text or "") for r in after)


def test_pieces_stage(steps):
    v = pieces.Pieces(pieces.read_model())
    text = {r.doc_id: r.text for r in steps[4].collect()}
    for r in steps[5].collect():
        assert (None if r.ids is None else v.decode(r.ids).decode()) == text[r.doc_id]


def test_run_and_registration(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and 0 < out.count() < 200
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(queries.QUERIES) <= set(names)


def test_empty_pipeline(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
        assert df.count() == 0



def test_columns_of_any_name_pass_through(spark):
    """Columns that operators use for results come out as they went in."""
    names = ["base", "spans", "keep", "items", "n_words", "n_hit", "hit_words", "p_tail", "expected_grade", "component_id", "chunk", "__text"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n + " of "), F.col("doc_id").cast("string")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF))
        rows = docs.collect()
        assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)


def test_texts_cross_to_the_workers_once(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "web", 3, True)],
                                 "doc_id long, text string, lang string, source string, n_chars long, keep boolean")

    def sent(df):
        todo, found = [df._jdf.queryExecution().analyzed()], []
        while todo:
            node = todo.pop()
            below = [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "MapInArrow":
                found.append([a.name() for a in map(below[0].output().apply, range(below[0].output().size()))])
            todo += below
        return found

    ((*quality_sent,),) = sent(quality.score(corpus_pipeline._aside(docs), None))
    assert quality_sent == ["doc_id", "text", "__doc_2", "__doc_3", "__doc_4", "__doc_5"]
    ((*pieces_sent,),) = sent(pieces.encode(docs.select("doc_id", "text"), pieces.read_model()))
    assert pieces_sent == ["doc_id", "text"]
    # a text of another type is read as a string and kept as it is
    raw = docs.withColumn("text", F.col("text").cast("binary"))
    assert sent(quality.score(raw, None))[0][-1] == "__text"
    assert bytes(quality.score(raw, None).first().text) == b"a b"


def test_near_duplicates_pack_texts_once_and_sort_none(spark, monkeypatch):
    packed, pack = [], corpus_pipeline.chunk_table
    counted = lambda *a: packed.append(1) or pack(*a)
    monkeypatch.setattr(corpus_pipeline, "chunk_table", counted)
    monkeypatch.setattr(minhash.C, "chunk_table", counted)
    long = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(3, long), (1, long), (2, "other words here"), (None, long), (4, None), (3, long)],
                                 "doc_id long, text string")
    found = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in found.collect()) == [(False, 1), (False, 2), (False, 4), (True, 0)]
    assert len(packed) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan
