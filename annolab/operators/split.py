"""Deterministic stratified train / validation split (W01), its feasibility
test (W02), per-class sampling (W03) and the split summary (A05).

Contract (a distributed stand-in for a seeded permutation):

* ``n_val = ceil(fraction * n)`` in double arithmetic;
* class quota by largest remainder of ``n_val * n_c / n``; ties to the
  smaller label;
* inside a class the rows with the smallest ``md5(seed ':' row_id)`` are
  validation rows.

Plan (no task ever holds a whole class):

1. count rows per (label, hash bucket) - partial aggregate, bucket = first
   ``digits`` hex characters of the row hash, so at most 16^digits * K rows;
2. quotas and per-bucket offsets are computed on that small table;
3. the table is broadcast back (its size is bounded by 16^digits * K, not by
   the data): a bucket wholly below the quota is validation, wholly above is
   training - map-only;
4. only the one boundary bucket per class (1/16^digits of it) is ranked with a
   window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_hash(row_id: str | Column, seed: int) -> Column:
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(F.lit(f"{seed}:"), rid.cast("string")))


def class_quotas(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Per-class size and validation quota from a (label, n) table (K rows).

    Adds n_total, n_val, quota, and the W02 feasibility flag."""
    whole = Window.partitionBy()  # K rows only
    c = (counts.withColumn("n_total", F.sum("n").over(whole))
         .withColumn("n_classes", F.count(F.lit(1)).over(whole))
         .withColumn("n_val", F.ceil(F.lit(float(fraction)) * F.col("n_total").cast("double")).cast("long"))
         .withColumn("exact", F.col("n_val") * F.col("n"))
         .withColumn("base", F.expr("exact div n_total"))
         .withColumn("remainder", F.expr("exact % n_total")))
    c = c.withColumn("need", F.col("n_val") - F.sum("base").over(whole))
    c = c.withColumn("rem_rank", F.row_number().over(
        Window.partitionBy().orderBy(F.desc("remainder"), F.asc(label))))
    c = c.withColumn("quota", F.col("base") + F.when(F.col("rem_rank") <= F.col("need"), 1).otherwise(0))
    feasible = ((F.min("n").over(whole) >= 2)
                & (F.col("n_val") >= F.col("n_classes"))
                & ((F.col("n_total") - F.col("n_val")) >= F.col("n_classes")))
    return c.withColumn("feasible", feasible).select(
        label, "n", "n_total", "n_classes", "n_val", "quota", "feasible")


def split_feasibility(df: DataFrame, label: str = "label", fraction: float = 0.15) -> DataFrame:
    """One row per class with the global feasibility verdict."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return class_quotas(counts, label, fraction)


def stratified_split(df: DataFrame, label: str = "label", row_id: str = "doc_id",
                     fraction: float = 0.15, seed: int = 42, digits: int = 4,
                     materialize_plan: bool = True) -> DataFrame:
    """Add ``split`` in {'train','val'}; NULL for every row when the split
    is infeasible (W02 -> S07 fallback: the table is kept whole, unsplit).

    ``materialize_plan`` writes the bounded per-bucket plan once (one small
    job), so the input is counted once instead of once per union branch."""
    h = row_hash(row_id, seed)
    hashed = df.withColumn("_h", h).withColumn("_bucket", F.substring("_h", 1, digits))
    counts = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    per_class = counts.groupBy(label).agg(F.sum("_cnt").alias("n"))
    quotas = class_quotas(per_class, label, fraction).select(label, "quota", "feasible")
    w = (Window.partitionBy(label).orderBy("_bucket")
         .rowsBetween(Window.unboundedPreceding, -1))
    plan = (counts.join(quotas, label)
            .withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
            .withColumn("_status",
                        F.when(~F.col("feasible"), F.lit("none"))
                        .when(F.col("_before") + F.col("_cnt") <= F.col("quota"), F.lit("val"))
                        .when(F.col("_before") >= F.col("quota"), F.lit("train"))
                        .otherwise(F.lit("boundary")))
            .withColumn("_need", F.col("quota") - F.col("_before"))
            .select(label, "_bucket", "_status", "_need"))
    if materialize_plan:
        from annolab.session import materialize
        plan = materialize(plan, "split-plan")
    # bounded by 16^digits * K rows, independent of the data volume
    joined = hashed.join(F.broadcast(plan), [label, "_bucket"])
    decided = (joined.filter(F.col("_status") != "boundary")
               .withColumn("split", F.when(F.col("_status") == "none", F.lit(None).cast("string"))
                           .otherwise(F.col("_status"))))
    rank_w = Window.partitionBy(label, "_bucket").orderBy("_h", row_id)
    boundary = (joined.filter(F.col("_status") == "boundary")
                .withColumn("split", F.when(F.row_number().over(rank_w) <= F.col("_need"), F.lit("val"))
                            .otherwise(F.lit("train"))))
    cols = [c for c in df.columns] + ["split"]
    return decided.select(*cols).unionByName(boundary.select(*cols))


def sample_per_class(df: DataFrame, label: str = "label", row_id: str = "doc_id",
                     k: int = 2, seed: int = 42) -> DataFrame:
    """Up to ``k`` rows per class, the ones with the smallest row hash.
    ``row_number() <= k`` lets Spark insert a per-task group limit before the
    shuffle, so a huge class sends only k rows per task."""
    w = Window.partitionBy(label).orderBy(row_hash(row_id, seed), F.col(row_id))
    return (df.withColumn("sample_rank", F.row_number().over(w))
            .filter(F.col("sample_rank") <= k))


def split_summary(split_df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split; share of train / val in % of train+val (2 dp);
    a ``total`` row for all rows."""
    per = split_df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # one row per split value
    tv = F.sum(F.when(F.col(split).isin("train", "val"), F.col("n")).otherwise(0)).over(whole)
    per = per.withColumn("pct", F.when(F.col(split).isin("train", "val"),
                                       F.round(F.col("n") * 100.0 / tv, 2)))
    total = per.agg(F.lit("total").alias(split), F.sum("n").alias("n"),
                    F.lit(None).cast("double").alias("pct"))
    return per.unionByName(total)
