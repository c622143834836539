"""Registered queries that write a file format to the shared folder and read it
back (S01-S09, S11, S12, S14), each against plain SQL over the tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from annolab.config import DEFAULTS
from annolab.operators import embed as EM
from annolab.operators import history as H
from annolab.operators.mlp import Network
from annolab.plans.catalog import SQL_SPLIT, dataset, register
from annolab.plans.queries_models import fixed_network
from annolab.plans.queries_profile import SQL_CORPUS, SQL_HIST, W, annotation_records
from annolab.session import materialize, shared_path
from annolab.sources import tables as TB
from annolab.sources import testdata as T
from annolab.sources.annotations import read_annotations

#: the text writer names its files *.txt, and a folder is named area=<kind>
WRITTEN = replace(DEFAULTS, file_glob="*.txt", consensus_marker="/area=consensus/")
FILE_DOCS = 200


def scratch(spark, name: str) -> str:
    """A path in the shared folder, deleted when the driver ends."""
    path = shared_path(spark, "files", f"{name}-{uuid.uuid4().hex}")
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def write_arrays(records, path: str) -> None:
    """records (area, file, seq, rec): one file with a JSON array per (area, file)."""
    bodies = records.groupBy("area", "file").agg(F.array_sort(F.collect_list(F.struct("seq", "rec"))).alias("r"))
    bodies.select("area", "file", F.concat(F.lit("[\n"), F.array_join("r.rec", ",\n"), F.lit("\n]\n")).alias("body")) \
        .write.partitionBy("area", "file").text(path)


# ---------------------------------------------------------------- S01 S02 S04 P01-P07
@register("file_extract", W(SQL_CORPUS) + """
SELECT CASE WHEN filename IN ('src0', 'src1', 'src2', 'src3') THEN 'consensus' ELSE 'regular' END AS kind,
       md5(text) AS text_md5, label, count(*) AS n
FROM corpus WHERE text IS NOT NULL AND text <> '' GROUP BY ALL""")
def q_file_extract(spark, sf_dir):
    c = T.corpus(spark, sf_dir)
    recs = annotation_records(c).join(c.select("doc_id", "filename"), "doc_id").select(
        F.when(F.col("filename").isin(*T.CONSENSUS_SOURCES), "consensus").otherwise("regular").alias("area"),
        F.floor(F.col("doc_id") / FILE_DOCS).alias("file"), F.col("doc_id").alias("seq"), "rec")
    path = scratch(spark, "annotations")
    write_arrays(recs, path)
    got = read_annotations(spark, path, WRITTEN)[0].where("text <> '' AND label IS NOT NULL")
    return got.groupBy("kind", F.md5("text").alias("text_md5"), "label").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- S03 and every kind of bad record
@register("quarantine", """
WITH d AS (SELECT doc_id, doc_id % 9 AS shape, CAST(floor(doc_id / 200) AS BIGINT) % 5 AS fileno,
                  CAST(floor(doc_id / 200) AS BIGINT) AS file FROM documents WHERE text IS NOT NULL AND text <> ''),
good AS (SELECT * FROM d WHERE fileno < 3)
SELECT 'malformed' AS reason, NULL AS detail, count(DISTINCT file) AS n FROM d WHERE fileno = 3 HAVING count(*) > 0
UNION ALL SELECT 'not_a_list', NULL, count(DISTINCT file) FROM d WHERE fileno = 4 HAVING count(*) > 0
UNION ALL SELECT 'not_an_object', NULL, count(*) FROM good WHERE shape IN (1, 2, 3) HAVING count(*) > 0
UNION ALL SELECT 'label_not_integer', 'N', count(*) FROM good WHERE shape = 4 HAVING count(*) > 0
UNION ALL SELECT 'text of label', label, count(*) FROM (
  SELECT CASE shape WHEN 0 THEN '2' WHEN 5 THEN '4' WHEN 7 THEN '3' WHEN 8 THEN '5' END AS label
  FROM good WHERE shape IN (0, 5, 7, 8)) GROUP BY label
UNION ALL SELECT 'no text', NULL, count(*) FROM good WHERE shape = 6 HAVING count(*) > 0""")
def q_quarantine(spark, sf_dir):
    """Each document as one of nine record shapes; of five files one is cut off and one
    is an object. Everything read is counted somewhere."""
    docs = T.table(spark, sf_dir, "documents").where("text IS NOT NULL AND text <> ''")
    text = F.to_json(F.struct("text"))                     # {"text":"..."}

    def with_label(choices):
        return F.concat(F.expr("substring(j, 1, length(j) - 1)"),
                        F.lit(f',"annotations":[{{"result":[{{"value":{{"choices":{choices}}}}}]}}]}}'))

    shape = F.col("doc_id") % 9
    rec = (F.when(shape == 0, with_label('["2 - low"]'))
           .when(shape == 1, F.col("doc_id").cast("string"))
           .when(shape == 2, F.lit('"{\\"text\\":\\"no record\\"}"'))
           .when(shape == 3, F.lit("null"))
           .when(shape == 4, with_label('["N/A"]'))
           .when(shape == 5, F.concat(F.lit('{"text":"first of two",'), F.expr("substring(j, 2)")))      # a repeated key
           .when(shape == 6, F.lit('{"text":0,"content":"not looked at"}'))
           .when(shape == 7, with_label('"3 - medium"'))
           .otherwise(with_label('[["5","1"]]')))
    rec = F.when(shape == 5, F.concat(F.expr("substring(r, 1, length(r) - 1)"), F.lit(
        ',"annotations":[{"result":[{"value":{"choices":["4"]}}]}]}'))).otherwise(F.col("r")), rec
    made = docs.withColumn("j", text).withColumn("r", rec[1]).withColumn("rec", rec[0])
    file = F.floor(F.col("doc_id") / FILE_DOCS)
    body = made.groupBy(file.alias("file")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "rec"))).alias("r")) \
        .withColumn("a", F.concat(F.lit("["), F.array_join("r.rec", ","), F.lit("]")))
    path = scratch(spark, "bad-annotations")
    body.select("file", F.when(F.col("file") % 5 == 3, F.expr("substring(a, 1, length(a) - 2)"))
                .when(F.col("file") % 5 == 4, F.concat(F.lit('{"records":'), "a", F.lit("}"))).otherwise(F.col("a")).alias("body")) \
        .write.partitionBy("file").text(path)
    recs, bad = read_annotations(spark, path, WRITTEN)
    good = recs.where("label IS NOT NULL OR label_raw IS NULL").select(
        F.when(F.col("text").isNull(), "no text").otherwise("text of label").alias("reason"),
        F.col("label").cast("string").alias("detail"))
    return (bad.select("reason", "detail").unionByName(good)
            .groupBy("reason", "detail").agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- S05 S06 S12
@register("csv_roundtrip", W(SQL_CORPUS) + """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, filename, md5(text) AS text_md5, label FROM corpus
WHERE text IS NOT NULL AND text <> ''""")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch(spark, "csv")
    c = T.corpus(spark, sf_dir).where("text <> ''")
    TB.write_csv(c.select(F.col("doc_id").cast("string"), "filename", "text", "label", F.lit("all").alias("split")), path)
    return TB.read_csv(spark, path).select("doc_id", "filename", F.md5("text").alias("text_md5"), "label")


# ---------------------------------------------------------------- S06 S07 S14
@register("split_table_roundtrip", "WITH " + SQL_SPLIT.strip() + """
SELECT doc_id, md5(text) AS text_md5, label, split FROM complete WHERE split IN ('train', 'val')""")
def q_split_table_roundtrip(spark, sf_dir):
    path = scratch(spark, "split")
    TB.write_split_table(dataset(spark, sf_dir)[1].complete, path)
    return TB.read_split(spark, path, "train", "val").select("doc_id", F.md5("text").alias("text_md5"), "label", "split")


# ---------------------------------------------------------------- S08
@register("embedding_cache", """
WITH t AS (SELECT DISTINCT text FROM documents)
SELECT (SELECT count(*) FROM t) AS encoded_first, CAST(0 AS BIGINT) AS encoded_again,
       (SELECT count(*) FROM t) AS encoded_other_dimension, (SELECT count(*) FROM documents) AS n_rows""")
def q_embedding_cache(spark, sf_dir):
    docs = T.table(spark, sf_dir, "documents", heavy=True).select("doc_id", "text")
    path = scratch(spark, "embeddings")

    def missing(dim):
        return EM.missing_texts(docs, path, EM.params_of(dim)).count()

    first = missing(DEFAULTS.embedding_dim)
    rows = EM.cached_embed(docs, path)
    again, other = missing(DEFAULTS.embedding_dim), missing(2 * DEFAULTS.embedding_dim)
    return rows.agg(F.lit(first).cast("long").alias("encoded_first"), F.lit(again).cast("long").alias("encoded_again"),
                    F.lit(other).cast("long").alias("encoded_other_dimension"),
                    F.count("embedding").alias("n_rows"))


# ---------------------------------------------------------------- S09
@register("model_roundtrip", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
h AS (SELECT vec_id, list_transform(range(0, 4), lambda u: greatest(0.0::DOUBLE,
        list_sum(list_transform(range(0, 64), lambda j: x[j + 1] * CAST((j * 7 + u * 5) % 13 - 6 AS DOUBLE) / 6.0::DOUBLE))
        + u * 0.1::DOUBLE - 0.15::DOUBLE)) AS h FROM e),
s AS (SELECT vec_id, 0.8::DOUBLE * h[1] - 0.6::DOUBLE * h[2] + 0.5::DOUBLE * h[3] - 0.3::DOUBLE * h[4] AS s FROM h)
SELECT vec_id, round((1 / (1 + exp(-(s - 1.0::DOUBLE)))) / (1 + 1e-8::DOUBLE), 6) AS top_class FROM s""")
def q_model_roundtrip(spark, sf_dir):
    path = scratch(spark, "network")
    fixed_network().save(spark, path)
    e = T.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return Network.load(spark, path).transform(e).select(
        "vec_id", F.round(F.element_at("probs", 5), 6).alias("top_class"))


# ---------------------------------------------------------------- S11
@register("history_roundtrip", W(SQL_HIST) + """
SELECT run_id, count(*) AS n, max(epoch) AS last_epoch, max(val_acc) AS best FROM h GROUP BY run_id""")
def q_history_roundtrip(spark, sf_dir):
    """Every part appended, and one of them a second time, as by a retry."""
    path = scratch(spark, "history")
    h = materialize(H.from_events(T.table(spark, sf_dir, "events")), "events")
    TB.append_history(h.where("run_id % 2 = 0"), path)
    TB.append_history(h.where("run_id % 2 <> 0"), path)
    TB.append_history(h.where("run_id % 3 = 0"), path)
    return TB.read_history(spark, path).groupBy("run_id").agg(
        F.count("*").alias("n"), F.max("epoch").alias("last_epoch"), F.max("val_acc").alias("best"))


# ---------------------------------------------------------------- L02
@register("sorted_classes", W(SQL_CORPUS) + """
SELECT label, n, CAST(row_number() OVER (ORDER BY label) AS INTEGER) AS place
FROM (SELECT label, count(*) AS n FROM corpus GROUP BY label)""")
def q_sorted_classes(spark, sf_dir):
    """The class counts in the order of the labels, the place as printed."""
    from annolab.operators.metrics import sorted_report

    counts = T.corpus(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
    rows = sorted_report(counts).agg(F.collect_list(F.struct("label", "n")).alias("r"))      # K rows
    return rows.select(F.posexplode("r").alias("i", "r")).select("r.label", "r.n", (F.col("i") + 1).alias("place"))
