"""Multi-model comparison.

Models that score the same rows add their columns in one pass (``score_columns``).
Separately stored outputs, each a long table (row_id, model, prediction,
confidence), are pivoted on the model names (known up front, so the pivot needs no
extra pass). Agreement is ``size(array_distinct(preds)) = 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = "model string, prediction int, confidence double"


def score_columns(df: DataFrame, scorers: dict[str, tuple[Column, Column]]) -> DataFrame:
    """J04 for scorers over the same rows: ``<model>_prediction`` / ``_confidence``
    columns from (prediction, confidence) expressions, map-only."""
    out = []
    for name, (prediction, confidence) in scorers.items():
        out += [prediction.cast("int").alias(f"{name}_prediction"), confidence.cast("double").alias(f"{name}_confidence")]
    return df.select("*", *out)


def long_predictions(scored: dict[str, DataFrame | None], row_id: str = "doc_id",
                     spark=None) -> DataFrame:
    """S10 + J04 input: union of the scorers that exist (None = artefact absent). With
    none at all the result is empty (``spark`` is needed then)."""
    parts = [df.select(row_id, F.lit(name).alias("model"), F.col("predicted").cast("int").alias("prediction"),
                       F.col("confidence").cast("double").alias("confidence"))
             for name, df in scored.items() if df is not None]
    if not parts:
        if spark is None:
            raise ValueError("no scorer is available; pass spark for an empty result")
        return spark.createDataFrame([], f"{row_id} long, {LONG}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def wide_predictions(long: DataFrame, models: list[str], row_id: str = "doc_id") -> DataFrame:
    """One row per text, ``<model>_prediction`` / ``<model>_confidence``."""
    agg = []
    for m in models:
        agg.append(F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(f"{m}_prediction"))
        agg.append(F.max(F.when(F.col("model") == m, F.col("confidence"))).alias(f"{m}_confidence"))
    return long.groupBy(row_id).agg(*agg) if agg else long.select(row_id).distinct()


def prediction_columns(df: DataFrame) -> list[str]:
    """P17."""
    return [c for c in df.columns if c.endswith("_prediction")]


def agreement(wide: DataFrame) -> DataFrame:
    """Do all models agree, and the predictions as 'model: class', joined by ', '.
    With fewer than two models there is no agreement to speak of: ``agree`` is NULL."""
    cols = prediction_columns(wide)
    agree = F.size(F.array_distinct(F.array(*[F.col(c) for c in cols]))) == 1 if len(cols) > 1 \
        else F.lit(None).cast("boolean")
    named = [F.concat(F.lit(c.removesuffix("_prediction") + ": "), F.coalesce(F.col(c).cast("string"), F.lit("-")))
             for c in cols]
    return (wide.withColumn("agree", agree)
            .withColumn("detail", F.concat_ws(", ", *named) if named else F.lit("")))


def agreement_rate(agreed: DataFrame) -> DataFrame:
    """Number of texts, agreeing texts and the rate in % (1 dp). No row when fewer
    than two models were compared."""
    rated = agreed.where(F.col("agree").isNotNull())
    return rated.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.col("agree").cast("int")).cast("long").alias("n_agree"),
                     F.round(F.avg(F.col("agree").cast("double")) * 100.0, 1).alias("agree_pct")).where("n > 0")
