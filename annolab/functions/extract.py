"""Text and label extraction from one semi-structured annotation record
(P01-P07), as built-in JSON / VARIANT expressions.

Semantics kept from the reference:

* text: if ``data`` is an object that *has* a ``text`` key, that value is the
  text even when null or empty (no fall-through); else the ``text`` key; else
  the ``content`` key; else the first string field that is not blank, in
  document order. A non-object record has no text. Non-string values are
  rendered as strings, except false, 0, [] and {}: they are no text.
* label: ``annotations[0].result[0].value.choices[0]`` (``choices`` may be a
  string: its first character), then its first character (string choice) or
  first element (array choice); empty -> none.

A record is one VARIANT (key presence, types and values are read from it). Key
*order* matters only for the fallback, and a VARIANT object sorts its keys, so
that branch takes the keys from ``json_object_keys`` (document order). A key that
occurs twice has its last value (``last_key_wins``). Columns that lambdas read
are materialised first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHOICES = "$.annotations[0].result[0].value.choices"
#: non-string values that count as absent, as rendered
FALSY = ("false", "0", "-0", "0.0", "-0.0", "[]", "{}")


def last_key_wins(spark: SparkSession) -> None:
    """Repeated keys are legal JSON: keep the last value instead of failing."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _blank(v: Column) -> Column:
    return v.rlike(r"^[\p{IsWhite_Space}]*$")


def _rendered(value: Column) -> Column:
    """A value as text; NULL for falsy values that are no strings."""
    as_text = value.cast("string")
    return F.when((F.schema_of_variant(value) == F.lit("STRING")) | ~as_text.isin(*FALSY), as_text)


def text_expr(rec: str = "rec", rec_map: str = "_rec_map", data_map: str = "_data_map") -> Column:
    """P01 + P02 over the parsed record: ``rec_map`` / ``data_map`` = the record /
    its ``data`` value as map<string, variant> (NULL when not an object). Only the
    fallback reads the raw JSON again, for the keys in document order."""
    m, dm = F.col(rec_map), F.col(data_map)
    keys = F.json_object_keys(F.col(rec))
    fallback_key = F.try_element_at(F.filter(keys, lambda k: (
        (F.schema_of_variant(F.element_at(m, k)) == F.lit("STRING"))
        & ~_blank(F.element_at(m, k).cast("string")))), F.lit(1))
    return (F.when(m.isNull(), F.lit(None).cast("string"))
            .when(F.coalesce(F.map_contains_key(dm, F.lit("text")), F.lit(False)),
                  _rendered(F.element_at(dm, F.lit("text"))))
            .when(F.map_contains_key(m, F.lit("text")), _rendered(F.element_at(m, F.lit("text"))))
            .when(F.map_contains_key(m, F.lit("content")), _rendered(F.element_at(m, F.lit("content"))))
            .otherwise(F.element_at(m, fallback_key).cast("string")))


def label_expr(v: str = "_rec_v") -> Column:
    """P03 + P04: first character of a string choice (or of a string in place of the
    choices), first element of an array choice; anything else -> NULL."""
    choices = F.expr(f"try_variant_get({v}, '{CHOICES}')")
    choice = F.expr(f"try_variant_get({v}, '{CHOICES}[0]')")
    first_elem = F.expr(f"try_variant_get({v}, '{CHOICES}[0][0]', 'string')")
    string = F.lit("STRING")
    first_char = F.when(F.schema_of_variant(choices) == string, choices.cast("string")) \
                  .when(F.schema_of_variant(choice) == string, choice.cast("string"))
    return (F.when(first_char.isNotNull(), F.nullif(F.substring(first_char, 1, 1), F.lit("")))
            .when(F.schema_of_variant(choice).startswith("ARRAY"), first_elem)
            .otherwise(F.lit(None).cast("string")))


def extract_records(records: DataFrame, rec: str = "rec", v: str | None = None) -> DataFrame:
    """Add ``text`` (P01/P02) and ``label_raw`` / ``label``.
    ``v`` names the record's VARIANT; without it each record is parsed once."""
    last_key_wins(records.sparkSession)
    parsed = (records.withColumn("_rec_v", F.col(v) if v else F.expr(f"try_parse_json({rec})"))
              .withColumn("_rec_map", F.expr("try_cast(_rec_v AS map<string, variant>)"))
              .withColumn("_data_map", F.expr("try_cast(try_variant_get(_rec_v, '$.data') "
                                              "AS map<string, variant>)")))
    out = (parsed.withColumn("text", text_expr(rec))
           .withColumn("label_raw", label_expr())
           .withColumn("label", F.expr("try_cast(label_raw AS INT)")))
    return out.drop("_rec_v", "_rec_map", "_data_map", *([v] if v else []))


def keep_labelled_text(df: DataFrame) -> DataFrame:
    """P05 + P06: text present and non-empty (blank text is kept), label present."""
    return df.filter(F.col("text").isNotNull() & (F.col("text") != "") & F.col("label").isNotNull())
