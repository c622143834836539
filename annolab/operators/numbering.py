"""Dense numbers over a whole table, without a single-task sort.

``dense_index`` range-partitions the rows by the order, sorts each range and writes it; a
row's place in its range comes with the write, the ranges' counts give their
offsets. A range holds about 1/n of the rows, whatever the order's values are, as long as
the order ends with a row id: equal leading values are then divided, too.

The offsets are one row per range, so they are joined as a broadcast.

L06: an epoch's order is by a hash of (seed, epoch, row id); its rows in batches of
``batch_size`` follow from the dense number. M15: means of batch means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.session import materialize

PLACE_BITS = 33            # of monotonically_increasing_id: place in the partition
SPLIT_ORDER = ("train", "val", "test")


def dense_index(df: DataFrame, *order, name: str = "index", ranges: int | None = None) -> DataFrame:
    """df plus ``name``: 0, 1, 2, ... by ``order`` (columns or expressions; NULLs first). Rows
    that agree in all of the order are numbered in any order. A column called ``name`` is
    replaced."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df.drop(name)
    keyed = base.select("*", *[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)])
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    ranged = keyed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop(*[f"_o{i}" for i in range(len(order))])
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*base.columns, (F.col("_before") + place).alias(name)))


def reindexed(complete: DataFrame, split: str = "split", row_id: str = "doc_id", name: str = "index") -> DataFrame:
    """The combined table numbered in the order train, val, test, others; within a split
    by row id."""
    rank = sum((F.when(F.col(split) == s, i).otherwise(0) for i, s in enumerate(SPLIT_ORDER)), F.lit(0))
    rank = F.when(F.col(split).isin(*SPLIT_ORDER), rank).otherwise(len(SPLIT_ORDER))
    return dense_index(complete, rank, row_id, name=name)


def epoch_batches(rows: DataFrame, epochs: int, row_id: str = "doc_id", settings: Settings = DEFAULTS) -> DataFrame:
    """(epoch, batch, row_id, position in the epoch) of ``epochs`` shuffled passes; the
    last batch of an epoch may be smaller. Row ids should be unique."""
    ids = rows.select(F.col(row_id).alias("row_id"))
    each = ids.select(F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), "row_id")
    shuffled = F.md5(F.concat_ws(":", F.lit(settings.seed), "epoch", "row_id"))
    numbered = materialize(dense_index(each, "epoch", shuffled, "row_id", name="place"), "epochs")
    # every epoch has the same rows, so its numbers begin at a multiple of their count
    sizes = numbered.groupBy("epoch").agg(F.min("place").alias("first"))
    return (numbered.join(F.broadcast(sizes), "epoch")
            .select("epoch", F.floor((F.col("place") - F.col("first")) / settings.batch_size).alias("batch"), "row_id",
                    (F.col("place") - F.col("first")).alias("place")))


def epoch_means(scored: DataFrame, batches: DataFrame, value: str, row_id: str = "doc_id") -> DataFrame:
    """(epoch, n_batches, n, mean of the batches' means) of a value per row."""
    per = (batches.join(scored.select(F.col(row_id).alias("row_id"), F.col(value).alias("_v")), "row_id")
           .groupBy("epoch", "batch").agg(F.avg("_v").alias("m"), F.count("_v").alias("n")))
    return per.groupBy("epoch").agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n").alias("n"), F.avg("m").alias("mean"))
