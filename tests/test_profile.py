from annolab.operators import profile as P


def hist(spark, lens, bins=5):
    df = spark.createDataFrame([("x" * n,) for n in lens], "text string")
    return [(r.bin, r.n) for r in P.length_histogram(df, bins=bins).orderBy("bin").collect()]


def test_histogram_all_equal(spark):
    assert hist(spark, [4, 4, 4]) == [(0, 3), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_histogram_max_in_last_bin_and_empty_bins(spark):
    assert hist(spark, [0, 1, 10]) == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 1)]


def test_imbalance_grades(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(2,)] * 1, "label int")
    r = P.imbalance(df).collect()[0]
    assert r.imbalance_ratio == 3.0 and r.grade == "significant"


def test_shares_are_of_all_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "label int")
    assert {r.label: (r.n, r.pct) for r in P.class_distribution(df).collect()} == {1: (2, 50.0), 2: (1, 25.0)}


def test_rows_without_label_are_no_class(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "abc"), (None, "abcd"), (2, "a")], "label int, text string")
    assert {r.label for r in P.length_by_class(df).collect()} == {1, 2}
    assert {r.label: r.weight for r in P.class_weights(df).collect()} == {1: 0.75, 2: 1.5}
    card = {r["class"]: (r.n, r.mean_len, r.min_len, r.max_len) for r in P.dataset_card(df).collect()}
    assert card == {"Class 1": (2, 2.0, 2, 3), "Class 2": (1, 1.0, 1, 1)}
