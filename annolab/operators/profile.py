"""Label and text-length profiling.

All aggregations are partial (count/sum/min/max/avg); the global ones then
operate on K-row class tables, where a window over the whole (tiny) table is
harmless. Scalars that feed a row-wise expression (histogram range) are
scalar subqueries: Spark evaluates them once and inlines the value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings


def text_length(col: str = "text"):
    """Characters (code points), like Python ``len``."""
    return F.length(F.col(col))


def class_distribution(df: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """A03 + A04: count per class, % of all rows (2 dp). Rows without a label are no
    class, but count among all rows."""
    by = list(by or [])
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))  # over the K-row count table
    return (counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 2))
            .filter(F.col(label).isNotNull()))


def length_by_class(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """Mean (2 dp), count, min, max of the text length per class (rows without
    a label belong to none)."""
    return (df.filter(F.col(label).isNotNull()).withColumn("_len", text_length(text)).groupBy(label)
            .agg(F.round(F.avg("_len"), 2).alias("mean_len"),
                 F.count(F.lit(1)).alias("n"),
                 F.min("_len").alias("min_len"),
                 F.max("_len").alias("max_len")))


def dataset_card(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """The summary card of each class: display name, rows, mean text length (0 dp,
    half to even), shortest and longest text."""
    ln = text_length(text)
    return (df.filter(F.col(label).isNotNull()).groupBy(label)
            .agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg(ln), 0).alias("mean_len"),
                 F.min(ln).alias("min_len"), F.max(ln).alias("max_len"))
            .select(class_name(label).alias("class"), "n", "mean_len", "min_len", "max_len"))


def length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Mean, exact median, sample std, min, max of the text length.

    The exact median buffers a value -> count map; lengths are integers, so
    the buffer is bounded by the number of distinct lengths, not rows."""
    ln = text_length(text)
    return df.agg(F.round(F.avg(ln), 6).alias("mean_len"),
                  F.round(F.median(ln), 6).alias("median_len"),
                  F.round(F.stddev_samp(ln), 6).alias("std_len"),
                  F.min(ln).alias("min_len"),
                  F.max(ln).alias("max_len"),
                  F.count(F.lit(1)).alias("n"))


def length_histogram(df: DataFrame, text: str = "text",
                     bins: int = DEFAULTS.histogram_bins) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept.

    ``bin = least(floor((len - lo) * bins / (hi - lo)), bins - 1)``; for integer
    lengths below 2^53 the single double division cannot cross an integer, so
    the bin is exact; lo = hi puts every row in bin 0.
    lo / hi are scalar subqueries: one small job each, value inlined."""
    lens = df.select(text_length(text).cast("long").alias("len"))
    lo = lens.select(F.min("len")).scalar()
    hi = lens.select(F.max("len")).scalar()
    width = hi - lo
    b = F.when(width == 0, F.lit(0).cast("long")).otherwise(
        F.least(F.floor(((F.col("len") - lo) * F.lit(bins)).cast("double") / width).cast("long"),
                F.lit(bins - 1).cast("long")))
    counts = lens.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").alias("bin"))
    step = width.cast("double") / F.lit(float(bins))
    return (edges.join(counts, "bin", "left")
            .select("bin",
                    F.round(lo + F.col("bin") * step, 6).alias("bin_lo"),
                    F.round(lo + (F.col("bin") + 1) * step, 6).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (K_present * n_c), keyed by label (rows without a
    label are left out)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # K rows
    return counts.withColumn(
        "weight", F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n")))


def imbalance(df: DataFrame, label: str = "label", settings: Settings = DEFAULTS) -> DataFrame:
    """Per class its count and size relative to the largest
    class; with the imbalance ratio max/min, its grade and the mean class size."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # K rows
    ratio = F.max("n").over(whole) / F.min("n").over(whole)
    return (counts.withColumn("rel_size", F.round(F.col("n") / F.max("n").over(whole), 6))
            .withColumn("imbalance_ratio", F.round(ratio, 6))
            .withColumn("grade", F.when(ratio < settings.balanced_below, F.lit("balanced"))
                        .when(ratio < settings.moderate_below, F.lit("moderate"))
                        .otherwise(F.lit("significant")))
            .withColumn("mean_size", F.round(F.avg("n").over(whole), 6)))


def column_profile(df: DataFrame) -> DataFrame:
    """Dtype and non-null count of every column, in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    dtypes = dict(df.dtypes)
    parts = ", ".join(f"'{c}', '{dtypes[c]}', `{c}`" for c in df.columns)
    return counts.select(F.expr(f"stack({len(df.columns)}, {parts}) AS (column, dtype, non_null)"))


def distinct_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """The distinct labels with the number of distinct labels."""
    d = df.filter(F.col(label).isNotNull()).select(label).distinct()
    return d.withColumn("n_labels", F.count(F.lit(1)).over(Window.partitionBy()))


def preview(col: str = "text", n: int = DEFAULTS.preview_chars):
    """Unconditional preview, first n characters + '...'."""
    return F.concat(F.substring(F.col(col), 1, n), F.lit("..."))


def truncate(col: str = "text", n: int = DEFAULTS.inference_preview_chars):
    """P10: longer than n characters -> first n + '...'."""
    return F.when(F.length(F.col(col)) > n, F.concat(F.substring(F.col(col), 1, n), F.lit("...")))\
        .otherwise(F.col(col))


def class_name(col: str = "label"):
    """Display name 'Class k'."""
    return F.format_string("Class %d", F.col(col))
