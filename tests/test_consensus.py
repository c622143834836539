from pyspark.sql import functions as F

from annolab.operators import consensus as C
from annolab.plans.dataset import build_dataset


def votes(spark, rows):
    return spark.createDataFrame(rows, "item string, label string, seq long")


def test_tie_goes_to_first_seen(spark):
    r = C.majority_vote(votes(spark, [("t", "y", 0), ("t", "x", 1)])).collect()
    assert [(x.item, x.label) for x in r] == [("t", "y")]


def test_majority_and_single_vote(spark):
    rows = [("a", "x", 0), ("a", "y", 1), ("a", "y", 2), ("b", "z", 5)]
    r = {x.item: x.label for x in C.majority_vote(votes(spark, rows)).collect()}
    assert r == {"a": "y", "b": "z"}


def test_vote_texts_keys_by_exact_text(spark):
    recs = spark.createDataFrame(
        [(1, 1, "same", 3), (2, 2, "same", 4), (3, 3, "same", 4), (4, 4, "same ", 2)],
        "doc_id long, seq long, text string, label int")
    r = {x.text: (x.label, x.first_row) for x in C.vote_texts(recs).collect()}
    assert r == {"same": (4, 1), "same ": (2, 4)}


def test_anti_and_semi_partition_the_regular_rows(spark):
    recs = spark.createDataFrame([
        (1, 1, "c.json", "consensus", "A", 2), (2, 2, "c.json", "consensus", "B", None),
        (3, 3, "r.json", "regular", "A", 1), (4, 4, "r.json", "regular", "B", 3),
        (5, 5, "r.json", "regular", "C", None), (6, 6, "r.json", "regular", "", 2),
        (7, 7, "r.json", "regular", "A", None)],
        "doc_id long, seq long, filename string, kind string, text string, label int")
    parts = build_dataset(recs, materialize=False)
    kept = {r.doc_id for r in parts.kept.collect()}
    dups = {r.doc_id for r in parts.duplicates.collect()}
    # B has no labelled consensus vote, so it is not a consensus text;
    # duplicates are counted before the label check (7 is unlabelled)
    assert dups == {3, 7}
    assert kept == {4}
    regular = {r.doc_id for r in parts.with_text.filter(F.col("kind") == "regular").collect()}
    unlabelled = {5}
    assert kept | dups | unlabelled == regular


def test_one_row_per_text_with_repeated_and_null_ids(spark):
    recs = spark.createDataFrame(
        [(None, 1, "no id", 3), (7, 2, "a", 4), (7, 2, "a", 4), (7, 3, "b", 2), (8, 4, None, 1)],
        "doc_id long, seq long, text string, label int")
    got = [(x.text_key, x.text, x.label, x.votes_total, x.first_row) for x in C.vote_texts(recs).collect()]
    assert len(got) == 4
    assert {r[1:] for r in got} == {("no id", 3, 1, None), ("a", 4, 2, 7), ("b", 2, 1, 7), (None, 1, 1, 8)}
    assert all((k is None) == (t is None) for k, t, *_ in got)
