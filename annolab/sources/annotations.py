"""Annotation files (S01-S04): every ``*.json`` file under a root, each a JSON
array of records, read as whole files and exploded to one row per element.

* S01 recursive scan, case-sensitive ``*.json``; ``_metadata.file_path``;
* S02 one row per array element with its position (file order kept);
* S03 nothing is lost silently: a file that is not a list, malformed or empty,
  and a record that is no object, can't be parsed or has a label that is not an
  integer, each has a quarantine row ``(path, pos, reason, detail)``;
* S04 consensus vs regular by a substring of the URL-decoded path below the
  root (so the root's own spelling decides nothing); base name.

An element is parsed on its own, never the file as one value: the size limit of
a VARIANT holds per record. A key that occurs twice keeps its last value.

``read_annotations`` reads a file by as many tasks as it has splits (``arrays.py``). The
streaming ingest reads files whole: there a file is one row of one task, up to the 2 GB of a
string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.config import DEFAULTS, Settings
from annolab.functions.extract import extract_records, last_key_wins
from annolab.sources.arrays import read_elements


def read_files(spark: SparkSession, root: str, settings: Settings = DEFAULTS) -> DataFrame:
    """(path, body) for every *.json file below root."""
    raw = (spark.read.option("recursiveFileLookup", True)
           .option("pathGlobFilter", settings.file_glob).text(root, wholetext=True))
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def below_root(spark: SparkSession, root: str):
    """The decoded path below the (qualified) root; the whole path if it is not
    below it, as for a root with wildcards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = path.getFileSystem(conf).makeQualified(path).toUri().getPath().rstrip("/")
    decoded = F.coalesce(F.expr("try_url_decode(path)"), F.col("path"))
    at = F.instr(decoded, base + "/")
    return F.when(at > 0, F.substring(decoded, at + len(base), F.length(decoded))).otherwise(decoded)


def classify(files: DataFrame, root: str, settings: Settings = DEFAULTS) -> DataFrame:
    """S03 + S04 per file: reason (NULL if good), kind, filename, elements."""
    spark = files.sparkSession
    last_key_wins(spark)
    # element by element: the text of each, and its value (which knows its type)
    parsed = (files.withColumn("texts", F.from_json("body", "array<string>"))
              .withColumn("values", F.from_json("body", "array<variant>")))
    whole = F.rtrim(F.regexp_replace("body", r"\s+$", "")).endswith("]")
    starts = F.col("body").rlike(r"^[\s\x{FEFF}]*\[")
    reason = (F.when(starts & (F.col("texts").isNull() | ~whole), F.lit("malformed"))
              .when(F.col("texts").isNull() | ~starts, F.when(F.expr("try_parse_json(body)").isNull(), F.lit("malformed"))
                    .otherwise(F.lit("not_a_list")))
              .when(F.size("texts") == 0, F.lit("empty")))
    return named(parsed.withColumn("reason", reason), root, settings).drop("body")


def named(files: DataFrame, root: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Kind and filename by the path below the root."""
    rel = below_root(files.sparkSession, root)
    return (files.withColumn("kind", F.when(rel.contains(settings.consensus_marker), F.lit("consensus"))
                             .otherwise(F.lit("regular")))
            .withColumn("filename", F.element_at(F.split(rel, "/"), -1)))


def explode_elements(classified: DataFrame) -> DataFrame:
    """(path, pos, kind, filename, rec, v, bad) for every element of good files.
    ``bad``: why the element is no usable record, or NULL. Where the values of a
    file could not be had at once (one record over the VARIANT limit), each
    element is parsed from its text."""
    values = F.coalesce("values", F.transform("texts", lambda t: F.lit(None).cast("variant")))
    good = classified.filter(F.col("reason").isNull())
    ex = (good.withColumn("many", F.col("values").isNull())
          .select("path", "kind", "filename", "many",
                  F.posexplode(F.arrays_zip(F.col("texts").alias("t"), values.alias("v"))).alias("pos", "e"))
          .select("path", "kind", "filename", "pos", F.col("e.t").alias("rec"),
                  F.when(F.col("many"), F.expr("try_parse_json(e.t)")).otherwise(F.col("e.v")).alias("v"), "many"))
    return unusable(ex).drop("many")


def unusable(elements: DataFrame) -> DataFrame:
    """Add ``bad``: why an element (rec, v, many: v was parsed from rec) is no usable record."""
    kind = F.schema_of_variant("v")
    bad = (F.when(F.col("rec").isNull(), F.lit("not_an_object"))
           .when(F.col("v").isNull(), F.when(F.col("many") & F.col("rec").startswith("{"), F.lit("unparsable"))
                 .otherwise(F.lit("not_an_object")))
           .when(~kind.startswith("OBJECT"), F.lit("not_an_object")))
    return elements.withColumn("bad", bad)


def all_records(spark: SparkSession, files: DataFrame, root: str, settings: Settings = DEFAULTS
                ) -> tuple[DataFrame, DataFrame]:
    """(classified files, every element with text, label_raw, label and bad)."""
    classified = classify(files, root, settings)
    return classified, extracted(explode_elements(classified))


def extracted(elements: DataFrame) -> DataFrame:
    """Elements with text, label_raw, label and bad."""
    recs = extract_records(elements, "rec", "v")
    bad = F.coalesce("bad", F.when(F.col("label_raw").isNotNull() & F.col("label").isNull(),
                                   F.lit("label_not_integer")))
    return recs.withColumn("bad", bad).select(
        F.sha2(F.concat_ws(":", "path", F.col("pos").cast("string")), 256).alias("doc_id"),
        F.struct("path", "pos").alias("seq"),
        "filename", "kind", "text", "label_raw", "label", "path", "pos", "bad")


def split_records(spark: SparkSession, root: str, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """As ``all_records``, every file read by as many tasks as it has splits."""
    last_key_wins(spark)
    files, elements = read_elements(spark, root, settings)
    elements = (elements.withColumn("many", F.col("v").isNull() & F.col("rec").isNotNull())
                .withColumn("v", F.coalesce("v", F.expr("try_parse_json(rec)"))))
    return (named(files, root, settings),
            extracted(named(unusable(elements).drop("many"), root, settings)))


def usable(recs: DataFrame) -> DataFrame:
    """Records that are objects. One whose label is no integer stays: it has a vote,
    as the vote is on the raw label."""
    return recs.filter(F.col("bad").isNull() | (F.col("bad") == "label_not_integer")).drop("bad")


def quarantine(classified: DataFrame, recs: DataFrame) -> DataFrame:
    """(path, pos, reason, detail); pos is NULL for whole files."""
    none = F.lit(None)
    whole = classified.filter(F.col("reason").isNotNull()).select(
        "path", none.cast("int").alias("pos"), "reason", none.cast("string").alias("detail"))
    single = recs.filter(F.col("bad").isNotNull()).select(
        "path", "pos", F.col("bad").alias("reason"), F.col("label_raw").alias("detail"))
    return whole.unionByName(single)


def read_annotations(spark: SparkSession, root: str, settings: Settings = DEFAULTS
                     ) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine). Records: doc_id (sha2 of path:pos), seq (path,
    pos), filename, kind, text, label_raw, label - ready for ``plans.dataset``."""
    classified, recs = split_records(spark, root, settings)
    return usable(recs), quarantine(classified, recs)
