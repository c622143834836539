"""The reference's stages as Spark jobs over real inputs (files -> tables ->
models -> reports). Each stage reads what the previous one wrote to shared
storage, so a lost executor only costs recomputation of its own stage."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.operators import metrics as M
from annolab.operators import profile as P
from annolab.plans.dataset import build_dataset, stage_counts
from annolab.sources import tables as TB
from annolab.session import materialize
from annolab.sources.annotations import quarantine, split_records, usable


def build_from_files(spark: SparkSession, root: str, out: str, settings: Settings = DEFAULTS):
    """Entry A: annotation files -> split table (Parquet, by split), the
    quarantine list, stage counters and the class distribution per split."""
    classified, recs = split_records(spark, root, settings)
    recs = materialize(recs, "records")            # every file is parsed once
    records = usable(recs)
    parts = build_dataset(records, settings)
    TB.write_split_table(parts.complete.select("doc_id", "filename", "text", "label", "split"),
                         f"{out}/complete")
    quarantine(classified, recs).write.mode("overwrite").parquet(f"{out}/quarantine")
    stage_counts(records, parts).write.mode("overwrite").parquet(f"{out}/stage_counts")
    split = TB.read_split(spark, f"{out}/complete")
    P.class_distribution(split, "label", by=["split"]).write.mode("overwrite").parquet(
        f"{out}/class_distribution")
    return split


def train_and_evaluate_baseline(spark: SparkSession, table: str, out: str,
                                settings: Settings = DEFAULTS):
    """Entry B: fit on train+val, score test, write predictions and reports."""
    from annolab.operators.models import fit_baseline
    fit = TB.read_split(spark, table, "train", "val")
    model = fit_baseline(fit, "text", "label", settings)
    model.save(f"{out}/baseline_model")
    test = TB.read_split(spark, table, "test")
    scored = model.transform(test).withColumn("correct", M.correct_flag())
    preds = scored.select("doc_id", "text", "label", "predicted", "correct",
                          *[F.get("probs", k).alias(f"prob_class_{k + 1}")
                            for k in range(settings.num_classes)])
    preds.write.mode("overwrite").parquet(f"{out}/baseline_predictions")
    return write_reports(scored.select(F.lit("baseline").alias("model"), "label", "predicted"), f"{out}/baseline")


def write_reports(pred, prefix: str):
    """The confusion matrix, the class report and the per-class accuracies (P13, A17-A23);
    returns the summary."""
    M.confusion_matrix(pred).write.mode("overwrite").parquet(f"{prefix}_confusion")
    cm = pred.sparkSession.read.parquet(f"{prefix}_confusion")
    M.classification_report(cm).write.mode("overwrite").parquet(f"{prefix}_report")
    M.per_class_accuracy(cm).write.mode("overwrite").parquet(f"{prefix}_class_accuracy")
    return M.summary(cm)


def train_and_evaluate_ordinal(spark: SparkSession, table: str, out: str, settings: Settings = DEFAULTS,
                               hidden: tuple = (), iterations: int = 10, run_id: str = "ordinal"):
    """Entry C: embed the texts (cached), fit the ordinal network on train in rounds with
    val scored after each, keep the weights of the best round and of the last, write the
    history (one row per round), score val and test, write predictions and reports."""
    from annolab.operators.embed import cached_embed
    from annolab.operators.training import fit_validated
    rows = cached_embed(TB.read_split(spark, table, "train", "val", "test")
                        .select("doc_id", "text", "label", "split"), f"{out}/embeddings", settings=settings)
    rows = materialize(rows, "embedded")
    run = fit_validated(rows, "embedding", "label", settings, hidden, ordinal=True, iterations=iterations)
    for net in (run.best, run.last):                         # inference embeds as the fit did
        net.config = net.config | {"encoder": "hashing", "settings": settings.to_json()}
    run.best.save(spark, f"{out}/ordinal_model")
    run.last.save(spark, f"{out}/ordinal_final_model")
    TB.append_history(run.history(spark, run_id), f"{out}/ordinal_history")
    scored = run.best.transform(rows).withColumn("correct", M.correct_flag())
    scored.select("doc_id", "split", "label", "predicted", "correct", "confidence",
                  *[F.get("probs", k).alias(f"prob_class_{k + 1}") for k in range(settings.num_classes)]) \
        .write.mode("overwrite").parquet(f"{out}/ordinal_predictions")
    pred = spark.read.parquet(f"{out}/ordinal_predictions")
    return write_reports(pred.where("split = 'test'").select(F.lit("ordinal").alias("model"), "label", "predicted"),
                         f"{out}/ordinal")


def texts_frame(spark: SparkSession, texts: list[str]):
    """A list of texts as a table with row ids in the order given."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def infer(spark: SparkSession, texts, models: str, out: str | None = None, settings: Settings = DEFAULTS):
    """Entry D (M16): score texts (a list, or a table with doc_id and text) with every
    saved model below ``models`` that exists, with the settings saved with it; returns (table, agreement rate). The table
    has a preview, a prediction and a confidence per model, and whether they agree; it is
    written as CSV if ``out`` is given."""
    from annolab.operators import compare as CMP
    from annolab.operators.embed import cached_embed
    from annolab.operators.mlp import Network
    from annolab.operators.models import BaselineModel
    rows = (texts_frame(spark, texts) if isinstance(texts, list) else texts).select("doc_id", "text")
    scored = {}
    if TB.exists(spark, f"{models}/baseline_model"):
        s = BaselineModel.load(f"{models}/baseline_model", settings).transform(rows)
        scored["Baseline"] = s.select("doc_id", "predicted", F.element_at("probs", F.col("predicted")).alias("confidence"))
    if TB.exists(spark, f"{models}/ordinal_model"):
        net = Network.load(spark, f"{models}/ordinal_model")
        own = Settings.from_json(net.config["settings"]) if "settings" in net.config else settings
        scored["MLP"] = net.transform(cached_embed(rows, None, settings=own).select("doc_id", "embedding"))
    wide = CMP.wide_predictions(CMP.long_predictions(scored, spark=spark), list(scored))
    table = rows.select("doc_id", P.truncate("text", settings.inference_preview_chars).alias("text")) \
        .join(CMP.agreement(wide), "doc_id", "left" if not scored else "inner")
    if out and scored:
        TB.write_csv(table.drop("agree", "detail"), out)
    return table, CMP.agreement_rate(table)
