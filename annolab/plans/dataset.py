"""Entry A: annotation records -> consensus test set + deduplicated, split
training data (P05, P06, A01, A02, J01, J02, W01, W02, U02, A06).

Input: records ``(doc_id, seq, filename, kind, text, label)``: ``doc_id`` is
the row id, ``seq`` orders the records (first seen = smallest; a number or a
struct such as (path, pos)), ``kind`` is 'consensus' or 'regular' and
``label`` may be NULL (unlabelled record). Records read from files also have
``label_raw``: the vote is on the raw label, and a text whose winning label is no
integer stays a consensus text but is no test row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.operators import consensus as C
from annolab.operators import split as S
from annolab.session import materialize as _materialize


@dataclass
class DatasetParts:
    with_text: DataFrame      # P05 survivors
    voted: DataFrame          # consensus texts with their majority label
    duplicates: DataFrame     # regular records whose text is a consensus text (J02)
    kept: DataFrame           # regular, not a consensus text, labelled (J01 + P06)
    split: DataFrame          # kept + split column (W01)
    complete: DataFrame       # U02: train + val + test


def has_text(col: str = "text"):
    """Text present and not empty (whitespace-only text is kept)."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(""))


def build_dataset(records: DataFrame, settings: Settings = DEFAULTS,
                  materialize: bool = True) -> DatasetParts:
    """``materialize`` writes the voted texts and the kept regular rows to the shared
    checkpoint folder: both have several readers (the split reads its input
    twice), and the vote and the anti-join run once."""
    with_text = records.filter(has_text())
    raw = "label_raw" if "label_raw" in records.columns else "label"
    consensus = with_text.filter((F.col("kind") == "consensus") & F.col(raw).isNotNull())
    voted = C.vote_texts(consensus, label=raw, seq="seq", row_id="doc_id")
    if raw != "label":
        voted = voted.withColumn("label", F.expr(f"try_cast({raw} AS INT)"))
    if materialize:
        voted = _materialize(voted, "voted")
    keys = C.consensus_keys(voted)
    regular = with_text.filter(F.col("kind") == "regular")
    duplicates = C.consensus_duplicates(regular, keys)
    kept = (C.drop_consensus_texts(regular, keys)
            .filter(F.col("label").isNotNull())
            .select("doc_id", "filename", "text", "label"))
    if materialize:
        kept = _materialize(kept, "kept")
    split = S.stratified_split(kept, "label", "doc_id", settings.val_fraction,
                               settings.seed, settings.split_hash_digits)
    test = voted.filter(F.col("label").isNotNull()).select(F.col("first_row").alias("doc_id"), F.lit("consensus").alias("filename"),
                        "text", "label", F.lit("test").alias("split"))
    complete = split.unionByName(test)
    return DatasetParts(with_text, voted, duplicates, kept, split, complete)


def stage_counts(records: DataFrame, parts: DatasetParts) -> DataFrame:
    """The printed stage counters as one long table (stage, n)."""
    rec = records.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.when(has_text(), 1).otherwise(0)).cast("long").alias("with_text"),
        F.sum(F.when(has_text() & (F.col("kind") == "consensus"), 1).otherwise(0)).cast("long")
        .alias("consensus_records"),
        F.sum(F.when(has_text() & (F.col("kind") == "regular"), 1).otherwise(0)).cast("long")
        .alias("regular_records"))
    rec_long = rec.select(F.expr(
        "stack(4, 'records', records, 'with_text', with_text, "
        "'consensus_records', consensus_records, 'regular_records', regular_records) AS (stage, n)"))
    others = [
        parts.voted.agg(F.lit("consensus_texts").alias("stage"), F.count(F.lit(1)).alias("n")),
        parts.duplicates.agg(F.lit("skipped_duplicates").alias("stage"), F.count(F.lit(1)).alias("n")),
        parts.kept.agg(F.lit("regular_kept").alias("stage"), F.count(F.lit(1)).alias("n")),
    ]
    out = rec_long
    for o in others:
        out = out.unionByName(o)
    return out
