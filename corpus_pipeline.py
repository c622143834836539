"""The corpus pipeline: quality, near-duplicates, decontamination, personal data, pieces.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that its
predecessor kept; its result is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.

Defined cases: NULL and empty texts are scored by the thresholds of the quality
model alone, are near duplicates of nothing, hold no benchmark words and no
personal data, and give NULL or no ids; documents with a NULL id are never taken
for duplicates; rows that repeat an id and text stay or go together; an empty
table stays empty through all stages; further columns of ``documents`` are passed
on up to the last stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.llm import decontaminate, minhash, pieces, pii, quality
from annolab.llm.common import Scratch, chunk_table

#: near duplicates: words of a shingle and per cent of the union. Five words and 80 find
#: texts that differ by a block; three and 85 short texts that differ by a word, which costs
#: five shingles of five words and only three of three.
LINKS = ((5, 80), (3, 85))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: columns that operators read and keep or replace; the others they must not touch
READ = ("doc_id", "text")


def _aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and every other column of docs under a name that no operator uses."""
    return docs.select(*READ, *[F.col(f"`{c}`").alias(f"__doc_{i}") for i, c in enumerate(docs.columns) if c not in READ])


def _back(found: DataFrame, docs: DataFrame, **new) -> DataFrame:
    """The columns of docs, those in ``new`` replaced."""
    return found.select(*[new.get(c, F.col(c if c in READ else f"__doc_{i}")).alias(c)
                          for i, c in enumerate(docs.columns)])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good (grade 2) with probability 1/2 or more; the rest goes."""
    ratings = _table(spark, sf_dir, "labels").select("doc_id", quality.grade_of().alias("grade"))
    model = quality.fit(docs, ratings)
    return _back(quality.score(_aside(docs), model).where("keep"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document goes if by any of ``LINKS`` its group holds a smaller id. The texts are
    packed once for all links. The list of those that go grows with the input, so both
    sides are dealt out by id; only the list is kept in memory, and no text is sorted."""
    scratch = Scratch(spark, "near_duplicates")
    chunks = chunk_table(scratch, docs)
    gone = [minhash.near_duplicates(docs, shingle, need, chunks).where(~F.col("kept")).select("doc_id")
            for shingle, need in LINKS]
    scratch.close()
    gone = reduce(DataFrame.unionByName, gone).distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    found = decontaminate.find_contamination(_aside(docs), _table(spark, sf_dir, "benchmark"))
    return _back(found.where("n_hit = 0"), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text."""
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text").isNull(), F.col(f"__doc_{docs.columns.index('n_chars')}")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType))
    return _back(pii.redact(_aside(docs)), docs, **new)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text."""
    known = docs.select("doc_id", "text", "lang", "source")
    return pieces.encode(known, pieces.read_model()).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("pieces", pieces_stage),
]

#: a fitted model decides in the first stage, which SQL can't express; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return scratch.result(STAGES[-1][1](spark, docs, sf_dir))
