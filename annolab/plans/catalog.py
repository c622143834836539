"""Registered queries (one per operator group of the inventory) and their
independent DuckDB SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables; each
oracle is plain SQL over the same tables registered as views. Computed columns
carry the same alias on both sides; doubles are rounded to 6 dp on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.config import DEFAULTS
from annolab.operators import consensus as C
from annolab.operators import profile as P
from annolab.operators import split as S
from annolab.plans import dataset as D
from annolab.sources import testdata as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL fixtures
SQL_ANNOTATED = """
annotated AS (
  SELECT d.doc_id, d.source AS filename,
         CASE WHEN d.source IN ('src0','src1','src2','src3') THEN 'consensus' ELSE 'regular' END AS kind,
         d.text, CAST(1 + l.quality + 2 * l.toxic AS INTEGER) AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
with_text AS (SELECT * FROM annotated WHERE text IS NOT NULL AND text <> ''),
cons_counts AS (
  SELECT text, label, count(*) AS n, min(doc_id) AS first_seq
  FROM with_text WHERE kind = 'consensus' AND label IS NOT NULL GROUP BY text, label),
voted AS (
  SELECT text, label, first_doc AS doc_id FROM (
    SELECT text, label,
           row_number() OVER (PARTITION BY text ORDER BY n DESC, first_seq) AS rn,
           min(first_seq) OVER (PARTITION BY text) AS first_doc
    FROM cons_counts) WHERE rn = 1),
regular AS (SELECT * FROM with_text WHERE kind = 'regular'),
kept AS (
  SELECT r.doc_id, r.filename, r.text, r.label FROM regular r
  WHERE r.label IS NOT NULL AND NOT EXISTS (SELECT 1 FROM voted v WHERE v.text = r.text))"""

SQL_SPLIT = SQL_ANNOTATED + """,
cls AS (SELECT label, count(*) AS n FROM kept GROUP BY label),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS n_total, count(*) AS n_classes,
               CAST(ceil(CAST(0.15 AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS BIGINT) AS n_val,
               min(n) AS min_n FROM cls),
q1 AS (SELECT c.label, c.n, t.n_val, t.n_total, t.n_classes, t.min_n,
              (t.n_val * c.n) // t.n_total AS base, (t.n_val * c.n) % t.n_total AS rem
       FROM cls c CROSS JOIN tot t),
q2 AS (SELECT *, n_val - sum(base) OVER () AS need,
              row_number() OVER (ORDER BY rem DESC, label) AS rr FROM q1),
quota AS (SELECT label, n, n_total, n_classes, n_val,
                 CAST(base + CASE WHEN rr <= need THEN 1 ELSE 0 END AS BIGINT) AS quota,
                 (min_n >= 2 AND n_val >= n_classes AND n_total - n_val >= n_classes) AS feasible
          FROM q2),
ranked AS (SELECT k.*, row_number() OVER (PARTITION BY k.label
                       ORDER BY md5('42:' || CAST(k.doc_id AS VARCHAR)), k.doc_id) AS rk FROM kept k),
split AS (
  SELECT r.doc_id, r.filename, r.text, r.label,
         CASE WHEN NOT q.feasible THEN NULL WHEN r.rk <= q.quota THEN 'val' ELSE 'train' END AS split
  FROM ranked r JOIN quota q ON r.label = q.label),
complete AS (
  SELECT doc_id, filename, text, label, split FROM split
  UNION ALL
  SELECT doc_id, 'consensus' AS filename, text, label, 'test' AS split FROM voted)"""


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body


# ---------------------------------------------------------------- Spark fixtures
def dataset(spark: SparkSession, sf_dir: str, materialize: bool = True
            ) -> tuple[DataFrame, D.DatasetParts]:
    records = T.annotated_documents(spark, sf_dir)
    return records, D.build_dataset(records, DEFAULTS, materialize)


# ---------------------------------------------------------------- A01 A02 W08
@register("majority_vote", """
WITH per AS (SELECT user_id AS item, event_type AS label, count(*) AS n, min(event_id) AS first_seq
             FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, first_seq) AS rn,
             sum(n) OVER (PARTITION BY item) AS tot, count(*) OVER (PARTITION BY item) AS nl,
             min(first_seq) OVER (PARTITION BY item) AS fs
      FROM per)
SELECT item, label, n AS votes_for, CAST(tot AS BIGINT) AS votes_total, nl AS n_labels,
       fs AS first_seq
FROM r WHERE rn = 1""")
def q_majority_vote(spark, sf_dir):
    return C.majority_vote(T.votes(spark, sf_dir))


# A03 A04 over the vote result
@register("vote_distribution", """
WITH per AS (SELECT user_id AS item, event_type AS label, count(*) AS n, min(event_id) AS first_seq
             FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC, first_seq) AS rn FROM per),
c AS (SELECT label, count(*) AS n FROM r WHERE rn = 1 GROUP BY label)
SELECT label, n, round(n * 100.0 / sum(n) OVER (), 2) AS pct FROM c""")
def q_vote_distribution(spark, sf_dir):
    return P.class_distribution(C.majority_vote(T.votes(spark, sf_dir)))


# ---------------------------------------------------------------- J01 P05 P06
@register("consensus_antijoin", _with(SQL_ANNOTATED, "SELECT doc_id, filename, label FROM kept"))
def q_consensus_antijoin(spark, sf_dir):
    _, parts = dataset(spark, sf_dir, materialize=False)
    return parts.kept.select("doc_id", "filename", "label")


# J02 + U03
@register("duplicate_count", _with(SQL_ANNOTATED, """
SELECT (SELECT count(*) FROM regular r WHERE EXISTS (SELECT 1 FROM voted v WHERE v.text = r.text))
         AS skipped_duplicates,
       (SELECT count(*) FROM voted) AS consensus_texts"""))
def q_duplicate_count(spark, sf_dir):
    _, parts = dataset(spark, sf_dir, materialize=False)
    dup = parts.duplicates.agg(F.count(F.lit(1)).alias("skipped_duplicates"))
    cons = parts.voted.agg(F.count(F.lit(1))).scalar()   # scalar subquery, no join
    return dup.select("skipped_duplicates", cons.alias("consensus_texts"))


# consensus test set: majority vote keyed by exact text
@register("consensus_vote", _with(SQL_ANNOTATED, "SELECT doc_id, label, length(text) AS text_len FROM voted"))
def q_consensus_vote(spark, sf_dir):
    _, parts = dataset(spark, sf_dir, materialize=False)
    return parts.voted.select(F.col("first_row").alias("doc_id"), "label",
                              F.length("text").alias("text_len"))


# ---------------------------------------------------------------- W01 U02
@register("dataset_split", _with(SQL_SPLIT, "SELECT doc_id, filename, label, split FROM complete"))
def q_dataset_split(spark, sf_dir):
    _, parts = dataset(spark, sf_dir)
    return parts.complete.select("doc_id", "filename", "label", "split")


# W02
@register("split_feasibility", _with(SQL_SPLIT,
          "SELECT label, n, n_total, n_classes, n_val, quota, feasible FROM quota"))
def q_split_feasibility(spark, sf_dir):
    _, parts = dataset(spark, sf_dir)
    return S.split_feasibility(parts.kept, "label", DEFAULTS.val_fraction)


# A05
@register("split_summary", "WITH " + SQL_SPLIT.strip() + """,
per AS (SELECT split, count(*) AS n FROM complete GROUP BY split)
SELECT split, n, CASE WHEN split IN ('train','val')
                      THEN round(n * 100.0 / (SELECT sum(n) FROM per WHERE split IN ('train','val')), 2)
                 END AS pct FROM per
UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT), NULL FROM per""")
def q_split_summary(spark, sf_dir):
    _, parts = dataset(spark, sf_dir)
    return S.split_summary(parts.complete)


# A03 A04 per split
@register("split_class_distribution", "WITH " + SQL_SPLIT.strip() + """,
c AS (SELECT split, label, count(*) AS n FROM complete GROUP BY split, label)
SELECT split, label, n, round(n * 100.0 / sum(n) OVER (PARTITION BY split), 2) AS pct FROM c""")
def q_split_class_distribution(spark, sf_dir):
    _, parts = dataset(spark, sf_dir)
    return P.class_distribution(parts.complete, "label", by=["split"])


# A06
@register("stage_counts", _with(SQL_ANNOTATED, """
SELECT 'records' AS stage, count(*) AS n FROM annotated
UNION ALL SELECT 'with_text', count(*) FROM with_text
UNION ALL SELECT 'consensus_records', count(*) FROM with_text WHERE kind = 'consensus'
UNION ALL SELECT 'regular_records', count(*) FROM with_text WHERE kind = 'regular'
UNION ALL SELECT 'consensus_texts', count(*) FROM voted
UNION ALL SELECT 'skipped_duplicates', count(*) FROM regular r
          WHERE EXISTS (SELECT 1 FROM voted v WHERE v.text = r.text)
UNION ALL SELECT 'regular_kept', count(*) FROM kept"""))
def q_stage_counts(spark, sf_dir):
    records, parts = dataset(spark, sf_dir)
    return D.stage_counts(records, parts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


# the other query groups register themselves on import
from annolab.plans import queries_files, queries_models, queries_profile  # noqa: E402,F401
