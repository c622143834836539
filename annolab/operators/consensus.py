"""Majority vote over multiply-annotated texts, and the exact-text anti / semi
joins that keep those texts out of the ordinary annotations.

A01 gather votes, A02 majority vote (tie -> label seen first), W08 first-seen
order, J01 left-anti join, J02 left-semi duplicate count, U03 distinct texts.

Scale notes
-----------
* Texts are keyed by ``sha2(text, 256)`` (32 bytes) so the shuffles move a
  fixed-size key, not 100 kB texts.
* Both vote aggregations are partial-aggregated (count / min / max_by), so a
  text that holds a third of all votes collapses map-side to one row per
  (task, label) before the shuffle: no hot task.
* The anti / semi joins are left to the planner: AQE turns them into a
  broadcast-hash join only when the measured consensus side is below
  ``spark.sql.autoBroadcastJoinThreshold``; beyond that they stay sort-merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(col: str | Column = "text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unhex(F.sha2(c, 256))


def vote_counts(votes: DataFrame, item: str = "item", label: str = "label",
                seq: str = "seq") -> DataFrame:
    """A01 + W08: one row per (item, label) with its vote count and first seq."""
    return (votes.groupBy(item, label)
            .agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("first_seq")))


def majority_vote(votes: DataFrame, item: str = "item", label: str = "label",
                  seq: str = "seq") -> DataFrame:
    """Per item the most frequent label; ties go to the label whose first
    vote came first (a Counter keeps insertion order). ``seq`` is any orderable
    column (a number, or a struct such as (path, pos)) that orders the votes."""
    per = vote_counts(votes, item, label, seq)
    return (per.groupBy(item)
            .agg(F.min_by(F.col(label), F.struct(-F.col("n"), F.col("first_seq"))).alias(label),
                 F.max("n").alias("votes_for"),
                 F.sum("n").alias("votes_total"),
                 F.count(F.lit(1)).alias("n_labels"),
                 F.min("first_seq").alias("first_seq")))


def vote_texts(records: DataFrame, text: str = "text", label: str = "label",
               seq: str = "seq", row_id: str = "doc_id") -> DataFrame:
    """Majority vote keyed by exact text. Returns (text_key, text, label,
    votes_for, votes_total, n_labels, first_seq, first_row); one row per
    distinct text; ``first_row`` is the row id of the text's first record.

    The vote runs on hash keys and row ids alone; the text is then fetched by its key
    (records that share a key share the text, whatever their ids), one per task and
    text, so every text crosses at most one shuffle. NULL texts have a key of their
    own, the empty one."""
    key = F.coalesce(text_key(text), F.lit(b""))
    keyed = records.select(key.alias("text_key"), F.col(label).alias(label),
                           F.col(seq).alias("seq"), F.col(row_id).alias("row_id"))
    per = (keyed.groupBy("text_key", label)
           .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "row_id")).alias("first")))
    won = (per.groupBy("text_key")
           .agg(F.min_by(F.col(label), F.struct(-F.col("n"), F.col("first.seq"))).alias(label),
                F.max("n").alias("votes_for"),
                F.sum("n").alias("votes_total"),
                F.count(F.lit(1)).alias("n_labels"),
                F.min("first").alias("first"))
           .withColumn("first_seq", F.col("first.seq")).withColumn("first_row", F.col("first.row_id")).drop("first"))
    texts = records.groupBy(key.alias("text_key")).agg(F.first(text).alias("text"))
    return won.join(texts, "text_key").select(F.nullif("text_key", F.lit(b"")).alias("text_key"), "text", label, "votes_for", "votes_total",
                                               "n_labels", "first_seq", "first_row")


def consensus_keys(voted: DataFrame) -> DataFrame:
    """The distinct consensus text keys (already distinct after the vote)."""
    return voted.select("text_key")


def drop_consensus_texts(regular: DataFrame, keys: DataFrame, text: str = "text") -> DataFrame:
    """Regular records whose exact text is not a consensus text."""
    return (regular.withColumn("text_key", text_key(text))
            .join(keys, "text_key", "left_anti").drop("text_key"))


def consensus_duplicates(regular: DataFrame, keys: DataFrame, text: str = "text") -> DataFrame:
    """Regular records whose text is a consensus text (to be counted)."""
    return (regular.withColumn("text_key", text_key(text))
            .join(keys, "text_key", "left_semi").drop("text_key"))
