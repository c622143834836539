"""Incremental ingest of annotation files with Structured Streaming.

New ``*.json`` files under a root are read whole (``wholetext``), classified,
exploded and extracted exactly like the batch reader; each micro-batch is
appended to a Parquet records table (exactly-once through the checkpoint).
The majority vote and the split stay batch jobs over that table, because they
need every vote of a text (no watermark bounds a text's votes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.sources.annotations import all_records, quarantine, usable


def stream_files(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.format("text").option("wholetext", True)
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
            .option("maxFilesPerTrigger", max_files_per_trigger).load(root)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))


def stream_records(spark: SparkSession, root: str, settings: Settings = DEFAULTS,
                   max_files_per_trigger: int = 1000) -> DataFrame:
    return usable(all_records(spark, stream_files(spark, root, max_files_per_trigger), root, settings)[1])


def stream_quarantine(spark: SparkSession, root: str, settings: Settings = DEFAULTS,
                      max_files_per_trigger: int = 1000) -> DataFrame:
    """The quarantine rows of the same files."""
    return quarantine(*all_records(spark, stream_files(spark, root, max_files_per_trigger), root, settings))


def start_ingest(spark: SparkSession, root: str, out_path: str, checkpoint: str,
                 settings: Settings = DEFAULTS, available_now: bool = True):
    """Append extracted records to ``out_path``; ``available_now`` processes
    what is there and stops (batch-like backfill), otherwise runs continuously."""
    w = (stream_records(spark, root, settings).writeStream.format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
