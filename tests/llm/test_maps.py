"""op1, op3, op4, op5, op6 and op10 against brute force, a library, or held-out rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import zstandard
import pytest
import sentencepiece
from pyspark.sql import functions as F

from annolab.llm import common, decontaminate, hmm, langid, pieces, quality, queries, topk

SF = "/root/testdata/sf0.001"
CASES = [(0, None), (1, ""), (2, "One"), (3, " \n\t "), (4, "ÀB cd-Ef 12"), (None, "a b c"), (2, "One")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, items string")


# ------------------------------------------------------------------ op1
@pytest.mark.parametrize("block", [1 << 20, 60])
def test_wu_manber_equals_window_search(spark, block):
    r = random.Random(3)
    vocab = ["a", "bb", "the", "über", "x9", "word", "longerword"]
    items = [(i, " ".join(r.choices(vocab, k=k))) for i, k in enumerate([1, 2, 3, 5, 9, 10, 11, 14, 30])]
    items += [(9, items[7][1]), (10, None), (11, "?!"), (None, "only here"), (5, items[5][1])]
    docs = CASES + [(20 + i, ", ".join(r.choices(vocab, k=r.randint(0, 60))).upper()) for i in range(60)]
    docs += [(90, "x. " * 3000 + items[8][1] + " tail"), (91, items[7][1] + "! " + items[6][1]), (92, "so ONLY, here it is")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = decontaminate.find_contamination(frame(spark, docs), bench, block_bytes=block)
    rows = got.join(decontaminate.digest(got).select(F.col("doc_id").alias("d"), "items_sha256", "n_items")
                    .distinct(), F.col("d").eqNullSafe(F.col("doc_id"))).collect()
    want = decontaminate.brute_force([t for _, t in docs], items)
    wanted = Counter((i, *want[k][:2], tuple(want[k][2])) for k, (i, _) in enumerate(docs))
    assert Counter((x.doc_id, x.n_words, x.n_hit, tuple(x["items"])) for x in got.collect()) == wanted
    for x in rows:
        assert x.items_sha256 == hashlib.sha256(",".join(x["items"]).encode()).hexdigest()
        assert x.n_items == len(x["items"])


def test_no_benchmark(spark):
    got = decontaminate.find_contamination(frame(spark, CASES), spark.createDataFrame([], "item_id long, text string"))
    assert got.where("n_hit > 0").count() == 0 and got.count() == len(CASES)


# ------------------------------------------------------------------ op3
def test_gradient_and_thresholds():
    r = np.random.default_rng(0)
    lens = r.integers(0, 5, 30)
    idx = r.integers(0, 8, lens.sum())
    starts, y = np.cumsum(lens) - lens, r.integers(0, 4, 30)

    def f(p):
        return quality.loss_and_gradient(p, idx, starts, lens, y, 4, 8, 0.5)

    x = r.normal(size=8 + 3) * 0.3
    _, g = f(x)
    for i in range(len(x)):
        e = np.zeros(len(x))
        e[i] = 1e-6
        assert abs((f(x + e)[0] - f(x - e)[0]) / 2e-6 - g[i]) < 1e-6


def test_quality_held_out(spark):
    """3,000 rated rows; a few hundred do not hold the words of all four languages."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", quality.grade_of().alias("grade"))
    model = quality.fit(docs, labels.where("doc_id % 4 <> 1"))
    assert all(np.diff(model.thresholds) > 0)
    held = quality.score(docs, model).join(labels.where("doc_id % 4 = 1"), "doc_id").select("keep", "grade").collect()
    assert len(held) > 500
    assert sum((x.grade == 2) == x.keep for x in held) / len(held) >= 0.95
    assert sum(x.keep for x in held if x.grade == 2) / sum(x.grade == 2 for x in held) >= 0.98


def test_quality_cases(spark):
    docs = frame(spark, CASES)
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert quality.score(docs, quality.fit(docs, none)).where("keep").count() == len(CASES)
    ratings = spark.createDataFrame([(2, 1), (4, 2), (4, None), (None, 2), (1, 7)], "doc_id long, grade int")
    out = quality.score(docs, quality.fit(docs, ratings)).collect()
    assert len(out) == len(CASES) and all(0 <= x.p_tail <= 1 for x in out)
    assert quality.score(docs.limit(0), None).collect() == []


def test_quality_draw_follows_the_ratings(spark):
    """A document with most of the ratings gets its share of the draw; texts repeated under an id
    do not multiply it; nothing drawn is an error."""
    ratings = spark.range(60_000).select(F.when(F.col("id") < 50_000, 7).otherwise(F.col("id")).alias("doc_id"),
                                         (F.col("id") % 3).cast("int").alias("grade"))
    docs = spark.range(49_990, 60_000).select(F.when(F.col("id") < 50_000, 7).otherwise(F.col("id")).alias("doc_id"),
                                              F.concat(F.lit("word"), F.col("id") % 10).alias("text"))
    seen = []
    before = quality.minimise
    quality.minimise = lambda f, x, n: seen.append(f.__closure__) or before(f, x, 1)
    try:
        model = quality.fit(docs, ratings, max_rows=1000)
    finally:
        quality.minimise = before
    rows = {c.cell_contents.shape for c in seen[0] if isinstance(c.cell_contents, np.ndarray)}
    assert model is not None and any(900 < s[0] < 1100 for s in rows)
    with pytest.raises(ValueError):
        quality.fit(docs, ratings, max_rows=0)


# ------------------------------------------------------------------ op4
def best_sum(v, text):
    """Best sum of scores over all segmentations, position by position."""
    text = " " + text
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            s = v.score.get(text[start:end], v.unknown if end - start == 1 else None)
            if s is not None:
                best[end] = max(best[end], best[start] + s)
    return best[-1]


def unigram_model():
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(pieces.read_model())
    m.trainer_spec.model_type = 1
    for p in m.pieces:                       # runs of spaces at -1e9 swallow the library's float sums
        p.score = max(p.score, -40_000.0)
    return m.SerializeToString()


TEXTS = ["", "Hello world", " two  spaces   here", "naïve café 東京 🙂", "a\nb\tc", "x" * 200, "==" * 90 + "-",
         "literal ▁ sign", "ab" * 500, "The quick brown fox, 1234567890!", " ", "▁", "é" * 70]


def test_best_segmentation_and_round_trip():
    v = pieces.Pieces(pieces.read_model())
    for t in TEXTS:
        ids = v.encode(t).tolist()
        assert v.decode(ids).decode() == t
        if "▁" in t:
            continue
        total, pending = 0.0, ids
        text = (" " + t) if t else ""
        at = 0
        while pending:                                   # score of the pieces; bytes of a character together
            i = pending[0]
            if i in v.byte.values():
                n = len(text[at].encode())
                total, pending, at = total + v.unknown, pending[n:], at + 1
            else:
                piece = v.text[i].decode()
                total, pending, at = total + v.score[piece], pending[1:], at + len(piece)
        assert total == (best_sum(v, t) if t else 0.0), t


def test_equals_the_library_on_words():
    model = unigram_model()
    v, lib = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    r = random.Random(4)
    words = re.findall(r"\w+", open(pieces.__file__).read()) + ["東京", "naïveté", "🙂", "Größe", "über"]
    words += ["".join(r.choices("etaoinshrdlu", k=r.randint(1, 12))) for _ in range(400)]
    same = [v.encode(w).tolist() == lib.encode(w) for w in words]
    assert all(same), [w for w, s in zip(words, same) if not s][:5]


def test_pieces_on_spark(spark):
    model = pieces.read_model()
    rows = CASES + [(50 + i, t) for i, t in enumerate(TEXTS)]
    out = pieces.decode(pieces.encode(frame(spark, rows), model), model).collect()
    assert len(out) == len(rows)
    for x in out:
        assert x.decoded == x.text and (x.ids is None) == (x.text is None)
        assert x["items"] == "old" and x.n_tokens == (None if x.ids is None else len(x.ids))


# ------------------------------------------------------------------ op5
def test_forward_is_exact():
    m = hmm.Model.initial(5, np.array([.3, .3, .2, .1, .1]), 3)
    seq = np.array([1, 2, 1, 0], dtype=np.uint16)
    _, grid, active = hmm.lanes([seq, seq[:2]])
    total, _, _ = hmm.forward(m, grid, active, False)

    def paths(s):
        import itertools
        return sum(m.start[p[0]] * m.emit[p[0], s[0]] * math.prod(
            m.move[a, b] * m.emit[b, x] for a, b, x in zip(p, p[1:], s[1:])) for p in itertools.product(range(3), repeat=len(s)))

    assert total == pytest.approx([math.log10(paths(seq)), math.log10(paths(seq[:2]))])


def test_training_raises_the_likelihood():
    r = np.random.default_rng(2)
    seqs = [np.r_[r.integers(1, 4, 20), 0].astype(np.uint16) if i % 2 else np.r_[r.integers(4, 7, 9), 0].astype(np.uint16)
            for i in range(60)]
    m, last = hmm.Model.initial(7, np.full(7, 1 / 7), 2), -math.inf
    for _ in range(12):
        s, a, b, total = hmm.expected(m, seqs)
        assert total >= last - 1e-9
        last = total
        assert b.sum() == pytest.approx(sum(map(len, seqs))) and s.sum() == pytest.approx(60)
        m = hmm.Model(s / s.sum(), a / a.sum(1, keepdims=True), b / b.sum(1, keepdims=True))


@pytest.mark.parametrize("heavy", [hmm.HEAVY, 50])
def test_base_score(spark, heavy):
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()] + CASES
    got = hmm.score(frame(spark, rows), iterations=2, heavy=heavy).collect()
    fold = {i: int(spark.range(1).select(F.crc32(F.lit(str(i)).cast("binary")) % 10).first()[0]) for i, _ in rows if i is not None}
    tokens = [(i, [w.decode() for w in hmm.words((t or "").encode())] + [None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if i is not None and fold[i] for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, ws in tokens:
        base = sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in ws)
        want[i, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)] += 1
    assert Counter((x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in got) == want
    assert all(x.held_out == (fold.get(x.doc_id) == 0) for x in got)
    assert sum(x.score for x in got) > sum(x.base_score for x in got)


def test_untrained_and_empty(spark):
    assert hmm.score(frame(spark, CASES).limit(0)).collect() == []
    got = hmm.score(frame(spark, [(None, "a b"), (None, None)])).collect()
    assert all(x.train_tokens == 0 and x.n_known == 0 and math.isfinite(x.score) for x in got)


# ------------------------------------------------------------------ op6
def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op6_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [x for x in out if x.held_out]
    assert len(out) == 1000 and sum(x.lang == x.lang_pred for x in held) / len(held) >= 0.93
    assert all(0 <= x.score <= 1 for x in out)


def test_language_cases(spark):
    docs = frame(spark, [*CASES, (9, "123 !!")])
    for content in ({}, {"xx": b"one two"}):
        out = {(x.doc_id, x.text): x for x in langid.identify(docs, content).collect()}
        assert out[0, None].lang_pred == out[9, "123 !!"].lang_pred == "und" and out[1, ""].score == 0
        assert out[2, "One"].lang_pred == ("xx" if content else "und")
    train = docs.select("doc_id", "text", F.when(F.col("doc_id") == 2, "xx").alias("lang"))
    assert langid.dictionaries(train) == {"xx": b"one\none\n"}


# ------------------------------------------------------------------ op10
@pytest.mark.parametrize("block,lists", [(4096, 4), (3, 3)])
def test_top_k_equals_brute_force(spark, block, lists):
    r = random.Random(1)
    rows = [(i, [r.uniform(-1, 1) for _ in range(r.choice([8, 8, 8, 5]))]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]                      # one very common vector
    rows += [(900, None), (950, [1.0, None]), (901, [float("nan")]), (1000, [float("inf")]), (None, [1.0] * 8),
             (1050, []), rows[50], (100, [0.5] * 8)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5),
                     block=block, lists=lists).collect()
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    best = []
    for q in sorted({i for i, _ in ok if i % 50 == 0}):
        qv = min(v for i, v in ok if i == q)
        score = {}
        for i, v in ok:
            if i != q:
                score[i] = max(score.get(i, -10 ** 9), sum(a * b for a, b in zip(qv, v)))
        best += [(q, k + 1, i, s) for k, (i, s) in enumerate(sorted(score.items(), key=lambda e: (-e[1], e[0]))[:5])]
    assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in got) == best


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (50, [-1.0])], "vec_id long, embedding array<double>")
    assert len(topk.top_k(df).collect()) == 4
    assert topk.top_k(df.limit(0)).collect() == []


def test_crc_fold(spark):
    import zlib
    assert spark.sql("select 12 as doc_id").select(common.crc_mod("doc_id", 10)).first()[0] == zlib.crc32(b"12") % 10


def test_dictionaries_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))                # a third of the rows twice
    one, many = (langid.dictionaries(docs.repartition(n), dict_bytes=20_000) for n in (1, 13))
    assert one == many and {len(c) for c in one.values()} == {20_000}
    short = spark.createDataFrame([(i, f"wort {i} und mehr", "de") for i in range(3000)], "doc_id long, text string, lang string")
    assert len({langid.dictionaries(short.repartition(n), dict_bytes=8000)["de"] for n in (1, 8)}) == 1


def test_pieces_come_from_whole_texts():
    text = ("a" * 30_000 + "é" * 5_000 + "z" * 30_000).encode()
    got = {langid.piece_of(text, h * 7919)[:1] for h in range(400)}
    assert got == {b"a", "é".encode()[:1], b"z"} and langid.piece_of("ü".encode(), 5, 1) in (b"", "ü".encode())


def test_smallest_compressed_size_wins():
    """Sizes by plain compression calls, without the operator's coder."""
    content = {"aa": b"the cat sat on the mat and the dog ran " * 40, "bb": "der hund und die katze sind im haus ".encode() * 40}
    coder = langid.Coder(content)
    for text in (b"the dog sat on the cat", "die katze und der hund".encode(), b"zzz qqq", b"The, mat! " * 700):
        folded = langid.fold(text)
        want = []
        for lang in ("aa", "bb"):
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(dict_data=d, level=langid.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            want.append(sum(len(c.compress(folded[i:i + langid.PIECE])) for i in range(0, len(folded), langid.PIECE)))
        assert coder.sizes(folded) == want
        assert coder.predict(text)[0] == ("aa" if want[0] <= want[1] else "bb")


def test_worker_memory_is_given_back(spark):
    """Looked up words are bounded, with the same features, and what one operator built in a
    worker is dropped when another reads chunks there."""
    texts = [b" ".join(b"w%d" % j for j in range(i, i + 900)) for i in range(0, 90_000, 900)]
    one, fresh = quality.Features(), quality.Features()
    for t in texts:
        got = one.of(t)
        assert len(one.seen) <= quality.SEEN <= 1 << 16
        if t in (texts[0], texts[-1]):
            assert np.array_equal(got, quality.Features().of(t))
    assert np.array_equal(np.sort(one.of(texts[3])), np.sort(fresh.of(texts[3])))

    class Shared:
        value = 1

    assert common.once(Shared(), lambda v: [v]) == [1] and common._built
    assert list(common.rows_of(iter([]))) == [] and not common._built
