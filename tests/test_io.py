import json
import re

from pyspark.sql import functions as F

from annolab.sources import tables as TB


def test_csv_round_trip_keeps_awkward_text(spark, tmp_path):
    rows = [("1", "f.json", 'He said "hi", then\nleft', 3, "train"), ("2", "f.json", "", 1, "val")]
    df = spark.createDataFrame(rows, TB.LABELLED_SCHEMA)
    TB.write_csv(df, str(tmp_path / "csv"))
    back = {r.doc_id: r.text for r in TB.read_csv(spark, str(tmp_path / "csv")).collect()}
    assert back == {"1": 'He said "hi", then\nleft', "2": None}


def test_split_table_partition_pruning(spark, tmp_path):
    rows = [("1", "f", "a", 1, "train"), ("2", "f", "b", 2, "val"), ("3", "consensus", "c", 2, "test")]
    TB.write_split_table(spark.createDataFrame(rows, TB.LABELLED_SCHEMA), str(tmp_path / "t"))
    got = TB.read_split(spark, str(tmp_path / "t"), "train", "val")
    assert sorted(r.doc_id for r in got.collect()) == ["1", "2"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*split", plan), plan


def test_streaming_ingest_matches_batch(spark, tmp_path):
    from annolab.sources.annotations import read_annotations
    from annolab.streaming.ingest import start_ingest
    root = tmp_path / "in"
    (root / "consensus").mkdir(parents=True)
    ann = lambda t, c: {"text": t, "annotations": [{"result": [{"value": {"choices": [c]}}]}]}
    json.dump([ann("A", "1"), ann("B", "2")], open(root / "r.json", "w"))
    json.dump([ann("A", "3")], open(root / "consensus" / "c.json", "w"))
    q = start_ingest(spark, str(root), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "kind", "text", "label")
    batch = read_annotations(spark, str(root))[0].select("doc_id", "kind", "text", "label")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_models_save_and_load(spark, tmp_path):
    from annolab.operators.models import OrdinalModel
    m = OrdinalModel([0.5, -0.25], [1.0, 0.0, -1.0], 4)
    m.to_frame(spark).write.parquet(str(tmp_path / "ord"))
    back = OrdinalModel.from_frame(spark.read.parquet(str(tmp_path / "ord")))
    assert back == m
    df = spark.createDataFrame([(1, [1.0, 2.0])], "doc_id long, embedding array<double>")
    r = back.transform(df).select("predicted", F.round("confidence", 6).alias("c")).collect()[0]
    assert 1 <= r.predicted <= 4


def test_baseline_fit_score_save_load(spark, tmp_path):
    from annolab.config import Settings
    from annolab.operators.models import BaselineModel, fit_baseline
    rows = [(i, f"good great fine text {i % 3}" if i % 2 else f"bad awful poor text {i % 3}", 1 + i % 2)
            for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    s = Settings(max_features=50, logreg_max_iter=50)
    m = fit_baseline(df, settings=s)
    m.save(str(tmp_path / "lr"))
    back = BaselineModel.load(str(tmp_path / "lr"), s)
    out = back.transform(df).collect()
    assert sum(r.predicted == r.label for r in out) == 40
    assert all(abs(sum(r.probs) - 1) < 1e-9 for r in out)


def test_stages_from_files(spark, tmp_path):
    from annolab.plans.stages import build_from_files
    root = tmp_path / "in"
    (root / "consensus").mkdir(parents=True)
    ann = lambda t, c: {"text": t, "annotations": [{"result": [{"value": {"choices": [c]}}]}]}
    json.dump([ann(f"text {i}", str(1 + i % 3)) for i in range(40)] + [ann("dup", "2")],
              open(root / "r.json", "w"))
    json.dump([ann("dup", "3"), ann("dup", "1"), ann("dup", "3")], open(root / "consensus" / "c.json", "w"))
    split = build_from_files(spark, str(root), str(tmp_path / "out"))
    got = {(r.split, r.text) for r in split.collect() if r.text == "dup"}
    assert got == {("test", "dup")}
    assert split.filter(F.col("split") == "val").count() == 6


def write_inputs(root):
    (root / "consensus").mkdir(parents=True)
    words = {1: "bad awful poor", 2: "plain dull grey", 3: "good great fine"}

    def ann(i, y):
        return {"text": f"{words[y]} text number {i}", "annotations": [{"result": [{"value": {"choices": [str(y)]}}]}]}

    json.dump([ann(i, 1 + i % 3) for i in range(90)] + [7, {"text": "t", "annotations": [
        {"result": [{"value": {"choices": ["N/A"]}}]}]}], open(root / "r.json", "w"), indent=1)      # over many lines
    json.dump([ann(1000 + i // 2, 1 + (i // 2) % 3) for i in range(24)], open(root / "consensus" / "c.json", "w"))


def test_stages_from_files_to_agreement(spark, tmp_path):
    from annolab.config import Settings
    from annolab.plans import stages as ST

    root, out = tmp_path / "in", str(tmp_path / "out")
    write_inputs(root)
    s = Settings(max_features=200, logreg_max_iter=50, num_classes=3)
    split = ST.build_from_files(spark, str(root), out, s)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 76, "val": 14, "test": 12}
    bad = {r.reason for r in spark.read.parquet(f"{out}/quarantine").collect()}
    assert bad == {"not_an_object", "label_not_integer"}

    texts = ["good great fine text", "bad awful poor text", "x" * 150]
    table, rate = ST.infer(spark, texts, out, settings=s)
    assert rate.collect() == [] and [r.doc_id for r in table.orderBy("doc_id").collect()] == [0, 1, 2]

    base = ST.train_and_evaluate_baseline(spark, f"{out}/complete", out, s).first()
    assert base.accuracy == 1.0 and base.n == 12
    table, rate = ST.infer(spark, texts, out, settings=s)
    assert rate.collect() == [] and table.first().agree is None

    net = ST.train_and_evaluate_ordinal(spark, f"{out}/complete", out, s, hidden=(8,), iterations=20).first()
    assert net.n == 12 and net.accuracy > 0.5
    table, rate = ST.infer(spark, texts, out, str(tmp_path / "csv"))      # the models bring their settings
    rows = {r.doc_id: r for r in table.collect()}
    assert rows[0].Baseline_prediction == 3 and rows[1].Baseline_prediction == 1
    assert rows[2].text == "x" * 100 + "..." and rows[0].detail.startswith("Baseline: 3, MLP: ")
    assert rate.first().n == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    for name in ("baseline", "ordinal"):
        for table in ("confusion", "report", "class_accuracy", "predictions"):
            assert spark.read.parquet(f"{out}/{name}_{table}").count() > 0


def test_embedding_cache(spark, tmp_path):
    from annolab.operators import embed as EM

    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d e"), (4, None)], "doc_id long, text string")
    path, calls = str(tmp_path / "cache"), str(tmp_path / "calls")

    def factory():
        def encode(texts):
            import uuid
            import os
            os.makedirs(calls, exist_ok=True)
            for t in texts:
                open(os.path.join(calls, uuid.uuid4().hex), "w").write(t)
            return [[float(len(t)), 1.0] for t in texts]
        return encode

    import os
    for _ in range(2):
        got = {r.doc_id: r.embedding for r in EM.cached_embed(
            df, path, model_name="len", encoder_factory=factory, dim=2).collect()}
        assert got == {1: [5.0, 1.0], 2: [5.0, 1.0], 3: [3.0, 1.0], 4: [0.0, 1.0]}
        assert len(os.listdir(calls)) == 3                    # the second run encodes nothing
    # another dimension, another vector
    a = EM.cached_embed(df, path).first().embedding
    from annolab.config import Settings
    b = EM.cached_embed(df, path, settings=Settings(embedding_dim=128)).first().embedding
    assert (len(a), len(b)) == (64, 128)


def test_no_scorer_and_one_scorer(spark):
    import pytest

    from annolab.operators import compare as CMP
    with pytest.raises(ValueError):
        CMP.long_predictions({"a": None})
    empty = CMP.agreement(CMP.wide_predictions(CMP.long_predictions({"a": None}, spark=spark), []))
    assert empty.collect() == [] and CMP.agreement_rate(empty).collect() == []
    one = spark.createDataFrame([(1, 2, 0.5)], "doc_id long, predicted int, confidence double")
    wide = CMP.agreement(CMP.wide_predictions(CMP.long_predictions({"m": one}), ["m"]))
    assert wide.first().agree is None and CMP.agreement_rate(wide).collect() == []
    both = CMP.agreement(CMP.wide_predictions(CMP.long_predictions({"m": one, "n": one}), ["m", "n"]))
    assert both.first().detail == "m: 2, n: 2" and CMP.agreement_rate(both).first().agree_pct == 100.0


def test_shared_folder(spark, monkeypatch):
    from annolab import session

    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    import pytest
    with pytest.raises(ValueError):
        session.shared_folder(Session)
    Context.getCheckpointDir = staticmethod(lambda: "hdfs:///ckpt/")
    assert session.shared_folder(Session) == "hdfs:///ckpt"
