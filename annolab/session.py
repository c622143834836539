"""SparkSession helpers: a configured local session for tests and bench, and the
shared checkpoint folder (read from the session, set only for a local master)."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "annolab") -> SparkSession:
    """Session for tests / bench. On a cluster use the cluster's builder instead;
    nothing in the library depends on these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ANNOLAB_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else
    the folder given to ``SparkContext.setCheckpointDir``. Only a local master may
    have neither; it gets a scratch folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="annolab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (for written intermediate tables)."""
    return "/".join([shared_folder(spark), *parts])


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage: write df as a Parquet table under the shared folder and read
    it back (survives executor loss; unlike an RDD checkpoint the result keeps
    column pruning and filter pushdown). Eager: one job. The table is deleted
    when the driver ends."""
    spark = df.sparkSession
    path = shared_path(spark, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """For CPU-heavy work per row (tokenising, JSON parsing) over a narrow scan, such
    as one file with one row group: deal the rows out to as many tasks as there are
    cores. A scan that has them already is returned as it is. Queries ask for this
    explicitly, where the work per row outweighs moving it."""
    want = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the workers, wherever the driver started."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="annolab-ship-"), "annolab_ship.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
