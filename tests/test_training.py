"""Validated fits, dense numbers, shuffled batches and appended histories."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolab.config import Settings
from annolab.operators import history as H
from annolab.operators import mlp as NN
from annolab.operators import numbering as N
from annolab.operators import training as TR
from annolab.sources import tables as TB

SMALL = Settings(hidden_dims=(6,), num_classes=3, epochs=6, early_stopping_patience=2)


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(1)
    out = []
    for i in range(240):
        x = r.normal(size=4)
        y = 1 + int(x[0] + x[1] > -0.5) + int(x[0] + x[1] > 0.5)
        out.append((i, [float(v) for v in x], y if i else None, ("val", "train", "train", "test")[i % 4] if i % 50 else None))
    return spark.createDataFrame(out, "doc_id long, embedding array<double>, label int, split string").cache()


@pytest.mark.parametrize("ordinal", [True, False])
def test_fit_validated(spark, rows, ordinal):
    run = TR.fit_validated(rows, settings=SMALL, ordinal=ordinal, iterations=5)
    hist = run.history(spark, "r")
    assert hist.columns == ["run_id", "epoch", "train_loss", "train_acc", "val_loss", "val_acc"]
    curves = sorted(map(tuple, hist.drop("run_id").collect()))
    accs = [c[4] for c in curves]
    assert run.best_epoch == accs.index(max(accs)) and run.best.config["epoch"] == run.best_epoch
    stop = H.early_stopping(hist, settings=SMALL).first()
    assert stop.best_epoch == run.best_epoch and stop.n_epochs == len(curves) and stop.best_val_acc == max(accs)
    assert len(curves) == min(SMALL.epochs, run.best_epoch + 1 + SMALL.early_stopping_patience)
    assert max(accs) > 60
    # the curves by hand: loss and accuracy of the kept network over val
    val = rows.where("split = 'val' AND label IS NOT NULL").collect()
    x, y = np.array([r.embedding for r in val]), np.array([r.label - 1 for r in val])
    train = [r.label for r in rows.where("split = 'train' AND label IS NOT NULL").collect()]
    weight = {k: len(train) / (3 * train.count(k)) for k in (1, 2, 3)}
    w = np.array([weight[k + 1] for k in y])
    p = run.best.probabilities(x)
    assert curves[run.best_epoch][4] == pytest.approx(100 * (p.argmax(1) == y).mean())
    if ordinal:
        z = (run.best.activations(x) @ run.best.head[0])[:, None] + run.best.head[1]
        t = y[:, None] > np.arange(2)
        loss = (w * np.logaddexp(0, np.where(t, -z, z)).sum(1)).mean()
    else:
        loss = (w * -np.log(p[np.arange(len(y)), y])).sum() / w.sum()
    assert curves[run.best_epoch][3] == pytest.approx(loss, rel=1e-6)


def test_fit_without_val_rows_keeps_the_last(spark, rows):
    s = Settings(hidden_dims=(3,), num_classes=3, epochs=3, early_stopping_patience=2)
    run = TR.fit_validated(rows.where("split = 'train'"), settings=s, ordinal=False, iterations=2)
    assert run.best is run.last and run.best_epoch is None and len(run.curves) == 2
    assert all(c[3] is None and c[4] is None for c in run.curves)
    with pytest.raises(ValueError):
        TR.fit_validated(rows.where("split = 'none'"), settings=s)


def test_extreme_logits_have_finite_losses():
    net = NN.Network([], (np.array([1000.0]), np.array([0.0, -1.0])), True)
    loss, ranked, likely = TR.row_losses(net, np.array([[1.0], [-1.0]]), np.array([0, 0]))
    assert loss.tolist() == [1999.0, 0.0] and ranked.tolist() == [2, 0] and likely.tolist() == [2, 0]


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_dense_index_equals_row_number(spark, ranges):
    r = random.Random(2)
    data = [(i, r.choice([None, "a", "b", "b", "b"]), "x") for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, k string, index string").repartition(7)
    got = N.dense_index(df, "k", "doc_id", ranges=ranges)
    want = sorted(data, key=lambda t: (t[1] is not None, t[1] or "", t[0]))
    assert [r.doc_id for r in got.orderBy("index").collect()] == [t[0] for t in want]
    assert sorted(r["index"] for r in got.collect()) == list(range(500))
    assert N.dense_index(df.limit(0), "k").collect() == []


def test_dense_index_with_one_value_for_all_rows(spark):
    """Ranges stay even: the row id divides equal values."""
    df = spark.range(4000).withColumn("k", F.lit(1))
    got = N.dense_index(df, "k", "id", ranges=8)
    assert got.where("id <> index").isEmpty() and got.count() == 4000


def test_reindexed_order(spark):
    df = spark.createDataFrame([(5, "test"), (4, "train"), (3, None), (2, "val"), (1, "train")], "doc_id long, split string")
    assert [r.doc_id for r in N.reindexed(df).orderBy("index").collect()] == [1, 4, 2, 5, 3]


def test_batches(spark):
    df = spark.range(70).withColumnRenamed("id", "doc_id")
    b = N.epoch_batches(df, 2).collect()
    orders = [[r.row_id for r in sorted((r for r in b if r.epoch == e), key=lambda r: r.place)] for e in (0, 1)]
    assert all(sorted(o) == list(range(70)) for o in orders) and orders[0] != orders[1] != list(range(70))
    assert sorted({(r.epoch, r.batch) for r in b}) == [(e, k) for e in (0, 1) for k in (0, 1, 2)]
    scored = df.withColumn("v", F.col("doc_id").cast("double"))
    got = {r.epoch: r for r in N.epoch_means(scored, N.epoch_batches(df, 2), "v").collect()}
    for e in (0, 1):
        means = [np.mean(orders[e][i:i + 32]) for i in (0, 32, 64)]
        assert got[e].n_batches == 3 and got[e].n == 70 and got[e]["mean"] == pytest.approx(np.mean(means))
    assert N.epoch_batches(df.limit(0), 2).collect() == []


def test_append_history_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "h")
    hist = spark.createDataFrame([(f"r{i}", e, float(i + e)) for i in range(40) for e in range(3)], "run_id string, epoch long, val_acc double")
    more = spark.createDataFrame([("r1", 0, 9.0), ("z", 0, 1.0)], "run_id string, epoch long, val_acc double")
    for part in (hist, hist, more, more):
        TB.append_history(part, path, buckets=4)
    got = sorted(map(tuple, TB.read_history(spark, path).select("run_id", "epoch", "val_acc").collect()))
    want = sorted([t for t in map(tuple, hist.collect()) if t[0] != "r1"] + [("r1", 0, 9.0), ("z", 0, 1.0)])
    assert got == want
    assert len(list((tmp_path / "h").glob("bucket=*"))) <= 4 and len(list((tmp_path / "h").rglob("*.parquet"))) <= 4
    TB.append_history(hist.limit(0), path)
    assert TB.read_history(spark, path).count() == len(want)


def test_fit_partitions_keep_cores_busy_and_even(spark):
    from annolab.operators.models import fit_partitions

    cores = spark.sparkContext.defaultParallelism
    few = spark.range(5000).coalesce(1)
    for work, want in ((0, 1), (2_000_000 * cores, cores), (10 ** 9, -(-10 ** 9 // (cores * 20_000_000)) * cores)):
        got = fit_partitions(few, work)
        assert got.rdd.getNumPartitions() == want
        sizes = got.rdd.glom().map(len).collect() if work else [5000]
        assert sum(sizes) == 5000 and max(sizes) - min(sizes) <= want


def test_rounds_write_no_tables(spark, rows, monkeypatch):
    """What a round of an ordinal network leaves does not grow with the rounds."""
    from annolab.operators import models as MD

    names = []
    for module in (MD, NN, TR):
        monkeypatch.setattr(module, "materialize", lambda df, name="table", was=TR.materialize: names.append(name) or was(df, name))
    runs = [TR.fit_validated(rows, settings=Settings(hidden_dims=(6,), num_classes=3, epochs=n, early_stopping_patience=9),
                             ordinal=True, iterations=2) for n in (1, 3)]
    assert [len(r.curves) for r in runs] == [1, 3] and len(names) % 2 == 0 and names[:len(names) // 2] == names[len(names) // 2:]
