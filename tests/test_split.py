import hashlib

from pyspark.sql import functions as F

from annolab.operators import split as S


def frame(spark, counts):
    rows, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            rows.append((i, label))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, label int")


def brute(rows, fraction=0.15, seed=42):
    import math
    n = len(rows)
    n_val = math.ceil(fraction * n)
    by = {}
    for rid, lab in rows:
        by.setdefault(lab, []).append(rid)
    base = {k: n_val * len(v) // n for k, v in by.items()}
    rem = {k: n_val * len(v) % n for k, v in by.items()}
    need = n_val - sum(base.values())
    order = sorted(by, key=lambda k: (-rem[k], k))
    quota = {k: base[k] + (1 if i < need else 0) for i, k in enumerate(order)}
    val = set()
    for k, ids in by.items():
        ids = sorted(ids, key=lambda r: (hashlib.md5(f"{seed}:{r}".encode()).hexdigest(), r))
        val |= set(ids[:quota[k]])
    return val


def test_quota_tie_goes_to_smaller_label(spark):
    df = frame(spark, {1: 10, 2: 10})
    out = S.stratified_split(df).collect()
    val = [r for r in out if r.split == "val"]
    assert len(val) == 3
    assert sum(1 for r in val if r.label == 1) == 2


def test_single_row_class_is_infeasible(spark):
    df = frame(spark, {1: 10, 2: 1})
    out = S.stratified_split(df).collect()
    assert all(r.split is None for r in out) and len(out) == 11


def test_matches_exact_rank_and_is_partition_independent(spark):
    counts = {1: 137, 2: 61, 3: 9, 4: 400}
    df = frame(spark, counts)
    rows = [(r.doc_id, r.label) for r in df.collect()]
    expect = brute(rows)
    for parts, digits in ((1, 1), (7, 2), (3, 4)):
        out = S.stratified_split(df.repartition(parts), digits=digits).collect()
        got = {r.doc_id for r in out if r.split == "val"}
        assert got == expect
        assert len(out) == len(rows)


def test_sample_per_class(spark):
    df = frame(spark, {1: 5, 2: 1})
    out = S.sample_per_class(df, k=2).collect()
    assert sorted(r.label for r in out) == [1, 1, 2]


def test_split_summary_total(spark):
    df = frame(spark, {1: 10, 2: 10})
    summ = {r.split: (r.n, r.pct) for r in S.split_summary(S.stratified_split(df)).collect()}
    assert summ["total"][0] == 20 and summ["val"] == (3, 15.0)
