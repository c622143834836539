"""The given parquet tables, and the reference-shaped inputs derived from them.

Every derivation is a lazy DataFrame over the tables, so its work grows with
them:

* ``annotated_documents`` - documents LEFT JOIN labels; the label is
  ``1 + quality + 2*toxic`` (NULL when unlabelled); sources src0..src3 play
  the consensus files, every other source a regular file.
* ``corpus`` - the labelled table (documents JOIN labels).
* ``votes`` - events as (item=user_id, label=event_type, seq=event_id).
* ``histories`` - events as training histories per user_id (epoch = order of
  event_id, val_acc = value).
* ``ordinal_embeddings`` - embeddings with ``label = floor(label/2) + 1``.
* ``signal_embeddings`` - embeddings with a label that the vector decides: the
  number of thresholds below the sum of its first two components, plus 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# fixed values of the fixture: which sources stand for consensus files
CONSENSUS_SOURCES = ("src0", "src1", "src2", "src3")


def table(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A given table; ``heavy``: for CPU-heavy work per row, a narrow scan is dealt
    out to all cores (session.spread)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if heavy else df


def label_expr(quality: str = "quality", toxic: str = "toxic"):
    return (F.lit(1) + F.col(quality) + F.lit(2) * F.col(toxic)).cast("int")


def annotated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, seq, filename, kind, text, label) - one annotation record per
    document; doc_id is both the row id and the record order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", label_expr().alias("label"))
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id", F.col("doc_id").alias("seq"),
                    F.col("source").alias("filename"),
                    F.when(F.col("source").isin(*CONSENSUS_SOURCES), F.lit("consensus"))
                    .otherwise(F.lit("regular")).alias("kind"),
                    "text", "label"))


def corpus(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Labelled table (F2): doc_id, filename, text, label, n_chars."""
    docs = table(spark, sf_dir, "documents", heavy).select("doc_id", "source", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", label_expr().alias("label"))
    return (docs.join(labels, "doc_id")
            .select("doc_id", F.col("source").alias("filename"), "text", "label", "n_chars"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes (F3): item, label, seq."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item"), F.col("event_type").alias("label"),
        F.col("event_id").alias("seq"))


def ordinal_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings (F4): vec_id, embedding array<double>, label 1..5."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    F.col("embedding").cast("array<double>").alias("embedding"),
                    (F.floor(F.col("label") / 2) + 1).cast("int").alias("label"))


SIGNAL_THRESHOLDS = (-0.2, -0.06, 0.06, 0.2)


def signal_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, embedding array<double>, label 1..5 that a model can learn."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    s = F.get("embedding", 0) + F.get("embedding", 1)
    above = sum((F.when(s > t, 1).otherwise(0) for t in SIGNAL_THRESHOLDS), F.lit(1))
    return e.withColumn("label", above.cast("int"))
