"""Scorers used to exercise the evaluation operators on the given tables, and
the fixed-weight ordinal head (fixture F8).

* ``length_rule``: class by text-length thresholds (predicts a class 5 that is
  never true - the 'predicted but never true' case of the metrics);
* ``mod_rule``: ``length(lower(text)) % 4 + 1``;
* ``ordinal_fixed``: CORAL head with ``w[j] = ((37 j) mod 17 - 8) / 17`` and
  biases 1.5, 0.5, -0.5, -1.5 over the 64-d embeddings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.functions import ordinal as O
from annolab.sources import testdata as T

# fixed values of the fixture
FIXED_BIASES = (1.5, 0.5, -0.5, -1.5)
LENGTH_THRESHOLDS = (1000, 2500, 5000, 10000)


def fixed_weights(dim: int) -> list[float]:
    return [((j * 37) % 17 - 8) / 17 for j in range(dim)]


def length_rule(df: DataFrame, n_chars: str = "n_chars"):
    c = F.col(n_chars)
    a, b, cc, d = LENGTH_THRESHOLDS
    return (F.when(c < a, 1).when(c < b, 2).when(c < cc, 3).when(c < d, 4).otherwise(5)).cast("int")


def mod_rule(text: str = "text"):
    return (F.length(F.lower(F.col(text))) % 4 + 1).cast("int")


def fixed_ordinal_scored(spark: SparkSession, sf_dir: str, dim: int = 64) -> DataFrame:
    """vec_id, label, score, z (K-1 logits), p (K probabilities)."""
    e = T.ordinal_embeddings(spark, sf_dir)
    w = O.lit_array(fixed_weights(dim))
    scored = e.withColumn("score", O.dot("embedding", w))
    scored = scored.withColumn("z", O.coral_logits(F.col("score"), O.lit_array(FIXED_BIASES)))
    return scored.withColumn("p", O.ordinal_probs("z"))


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rules over the same rows, in one pass."""
    c = T.corpus(spark, sf_dir)
    both = F.array(F.struct(F.lit("length_rule").alias("model"), length_rule(c).alias("predicted")),
                   F.struct(F.lit("mod_rule").alias("model"), mod_rule().alias("predicted")))
    return c.select("label", F.explode(both).alias("s")).select("s.model", "label", "s.predicted")


def all_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fixed_ordinal_scored(spark, sf_dir).select(
        F.lit("ordinal_fixed").alias("model"), "label", O.argmax_decode("p").alias("predicted"))
    return rule_predictions(spark, sf_dir).unionByName(o)
