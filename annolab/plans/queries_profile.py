"""Registered profiling, vocabulary, metrics, ordinal and history queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from annolab.config import DEFAULTS
from annolab.functions import ordinal as O
from annolab.operators import features as FE
from annolab.operators import history as H
from annolab.operators import metrics as M
from annolab.operators import profile as P
from annolab.operators import selection as SEL
from annolab.operators import split as S
from annolab.plans import evaluation as EV
from annolab.plans.catalog import SQL_ANNOTATED, SQL_SPLIT, dataset, register
from annolab.session import materialize, spread
from annolab.sources import testdata as T

SQL_CORPUS = """
corpus AS (SELECT d.doc_id, d.source AS filename, d.text,
                  CAST(1 + l.quality + 2 * l.toxic AS INTEGER) AS label, d.n_chars
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# ---------------------------------------------------------------- A03 A04
@register("class_distribution", W(SQL_CORPUS) + """
SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM corpus GROUP BY label""")
def q_class_distribution(spark, sf_dir):
    return P.class_distribution(T.corpus(spark, sf_dir))


# A07 A16
@register("length_by_class", W(SQL_CORPUS) + """
SELECT label, round(avg(length(text)), 2) AS mean_len, count(*) AS n,
       CAST(min(length(text)) AS INTEGER) AS min_len, CAST(max(length(text)) AS INTEGER) AS max_len
FROM corpus GROUP BY label""")
def q_length_by_class(spark, sf_dir):
    return P.length_by_class(T.corpus(spark, sf_dir))


# A16
@register("dataset_card", W(SQL_CORPUS) + """
SELECT 'Class ' || CAST(label AS VARCHAR) AS "class", count(*) AS n,
       round_even(avg(length(text)), 0) AS mean_len,
       CAST(min(length(text)) AS INTEGER) AS min_len, CAST(max(length(text)) AS INTEGER) AS max_len
FROM corpus GROUP BY label""")
def q_dataset_card(spark, sf_dir):
    return P.dataset_card(T.corpus(spark, sf_dir))


# A04 over records of which some have no label
@register("class_share", W(SQL_ANNOTATED) + """
SELECT label, n, pct FROM (
  SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
  FROM annotated GROUP BY label) WHERE label IS NOT NULL""")
def q_class_share(spark, sf_dir):
    return P.class_distribution(T.annotated_documents(spark, sf_dir))


# A08
@register("length_stats", W(SQL_CORPUS) + """
SELECT round(avg(length(text)), 6) AS mean_len, round(median(length(text)), 6) AS median_len,
       round(stddev_samp(length(text)), 6) AS std_len,
       CAST(min(length(text)) AS INTEGER) AS min_len, CAST(max(length(text)) AS INTEGER) AS max_len,
       count(*) AS n
FROM corpus""")
def q_length_stats(spark, sf_dir):
    return P.length_stats(T.corpus(spark, sf_dir))


@register("value_median", """
SELECT round(median(value), 6) AS median_value, count(value) AS n FROM events""")
def q_value_median(spark, sf_dir):
    """The exact median of a column with as many values as rows."""
    e = T.table(spark, sf_dir, "events")
    return e.agg(F.round(F.lit(SEL.exact_median(e, "value", few=100)), 6).alias("median_value"), F.count("value").alias("n"))


# A09
@register("length_histogram", W(SQL_CORPUS, """
l AS (SELECT CAST(length(text) AS BIGINT) AS len FROM corpus)""", """
r AS (SELECT min(len) AS lo, max(len) AS hi FROM l)""", """
b AS (SELECT CASE WHEN r.hi = r.lo THEN 0
             ELSE least(CAST(floor(CAST((l.len - r.lo) * 50 AS DOUBLE) / (r.hi - r.lo)) AS BIGINT), 49)
             END AS bin, count(*) AS n
      FROM l CROSS JOIN r GROUP BY 1)""", """
e AS (SELECT range AS bin FROM range(50))""") + """
SELECT e.bin, round(r.lo + e.bin * (CAST(r.hi - r.lo AS DOUBLE) / 50.0::DOUBLE), 6) AS bin_lo,
       round(r.lo + (e.bin + 1) * (CAST(r.hi - r.lo AS DOUBLE) / 50.0::DOUBLE), 6) AS bin_hi,
       coalesce(b.n, 0) AS n
FROM e CROSS JOIN r LEFT JOIN b ON e.bin = b.bin""")
def q_length_histogram(spark, sf_dir):
    return P.length_histogram(T.corpus(spark, sf_dir))


# A10 A11 A13
@register("imbalance", W(SQL_CORPUS, "c AS (SELECT label, count(*) AS n FROM corpus GROUP BY label)") + """
SELECT label, n, round(n / max(n) OVER (), 6) AS rel_size,
       round(max(n) OVER () / min(n) OVER (), 6) AS imbalance_ratio,
       CASE WHEN max(n) OVER () / min(n) OVER () < 1.5 THEN 'balanced'
            WHEN max(n) OVER () / min(n) OVER () < 3.0 THEN 'moderate' ELSE 'significant' END AS grade,
       round(avg(n) OVER (), 6) AS mean_size
FROM c""")
def q_imbalance(spark, sf_dir):
    return P.imbalance(T.corpus(spark, sf_dir))


# A12 (train split only)
@register("class_weights", "WITH " + SQL_SPLIT.strip() + """,
c AS (SELECT label, count(*) AS n FROM complete WHERE split = 'train' GROUP BY label)
SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c""")
def q_class_weights(spark, sf_dir):
    _, parts = dataset(spark, sf_dir)
    w = P.class_weights(parts.complete.filter(F.col("split") == "train"))
    return w.withColumn("weight", F.round("weight", 6))


# A14
@register("column_profile", W(SQL_CORPUS) + """
SELECT 'doc_id' AS "column", 'bigint' AS dtype, count(doc_id) AS non_null FROM corpus
UNION ALL SELECT 'filename', 'string', count(filename) FROM corpus
UNION ALL SELECT 'text', 'string', count(text) FROM corpus
UNION ALL SELECT 'label', 'int', count(label) FROM corpus
UNION ALL SELECT 'n_chars', 'bigint', count(n_chars) FROM corpus""")
def q_column_profile(spark, sf_dir):
    return P.column_profile(T.corpus(spark, sf_dir))


# A15
@register("distinct_labels", W(SQL_CORPUS) + """
SELECT label, count(*) OVER () AS n_labels FROM (SELECT DISTINCT label FROM corpus)""")
def q_distinct_labels(spark, sf_dir):
    return P.distinct_labels(T.corpus(spark, sf_dir))


# W03 + P11
@register("class_samples", W(SQL_CORPUS) + """
SELECT label, doc_id, substring(text, 1, 300) || '...' AS preview, length(text) AS text_len,
       sample_rank
FROM (SELECT *, row_number() OVER (PARTITION BY label
             ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS sample_rank FROM corpus)
WHERE sample_rank <= 2""")
def q_class_samples(spark, sf_dir):
    s = S.sample_per_class(T.corpus(spark, sf_dir), "label", "doc_id", DEFAULTS.samples_per_class,
                           DEFAULTS.seed)
    return s.select("label", "doc_id", P.preview("text").alias("preview"),
                    F.length("text").alias("text_len"), F.col("sample_rank"))


# L01
@register("head_rows", "WITH " + SQL_SPLIT.strip() + """
SELECT doc_id, filename, label, split FROM complete ORDER BY doc_id LIMIT 5""")
def q_head_rows(spark, sf_dir):
    _, parts = dataset(spark, sf_dir)
    return parts.complete.orderBy("doc_id").limit(5).select("doc_id", "filename", "label", "split")


# ---------------------------------------------------------------- T01-T05 L03
SQL_VOCAB = SQL_SPLIT.strip() + """,
fit AS (SELECT doc_id, text FROM complete WHERE split IN ('train', 'val')),
tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM fit),
grams AS (SELECT doc_id, unnest(list_concat(t, CASE WHEN len(t) >= 2
            THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
            ELSE [] END)) AS term FROM tok),
dt AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM dt GROUP BY term
       HAVING count(*) >= 2),
top AS (SELECT * FROM st ORDER BY tf DESC, term LIMIT 10000),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, tf, df FROM top)"""


def _vocab(spark, sf_dir):
    """The dataset's complete table dealt out for the tokenising (heavy per row), and
    the vocabulary of its train and val rows."""
    complete = spread(dataset(spark, sf_dir)[1].complete)
    fit = complete.filter(F.col("split").isin("train", "val"))
    return complete, FE.fit_vocabulary(fit, "doc_id", "text", DEFAULTS)


@register("vocabulary", "WITH " + SQL_VOCAB + "\nSELECT term, idx, tf, df FROM vocab")
def q_vocabulary(spark, sf_dir):
    return _vocab(spark, sf_dir)[1]


@register("vocabulary_pruned", "WITH " + SQL_VOCAB + "\nSELECT term, idx, tf, df FROM vocab")
def q_vocabulary_pruned(spark, sf_dir):
    """The same vocabulary with rare n-grams kept back before the shuffle."""
    fit = spread(dataset(spark, sf_dir)[1].complete.filter(F.col("split").isin("train", "val")))
    return FE.fit_vocabulary(materialize(fit.select("doc_id", "text"), "vocabulary-input"), "doc_id", "text", DEFAULTS, pruned=True)


SQL_DOC_TERMS = SQL_VOCAB + """,
atok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM complete),
agrams AS (SELECT doc_id, unnest(list_concat(t, CASE WHEN len(t) >= 2
            THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
            ELSE [] END)) AS term FROM atok),
adt AS (SELECT doc_id, term, count(*) AS tf FROM agrams GROUP BY doc_id, term),
long_form AS (SELECT a.doc_id, v.idx, a.tf FROM adt a JOIN vocab v ON a.term = v.term)"""


# T06 J05
@register("doc_term_counts", "WITH " + SQL_DOC_TERMS + "\nSELECT doc_id, idx, tf FROM long_form")
def q_doc_term_counts(spark, sf_dir):
    complete, vocab = _vocab(spark, sf_dir)
    return FE.vectorize_long(complete, vocab, "doc_id", "text", DEFAULTS)


# A25
@register("vocab_shape", "WITH " + SQL_DOC_TERMS + """
SELECT (SELECT count(*) FROM complete) AS n_docs, (SELECT count(*) FROM vocab) AS vocab_size,
       (SELECT count(*) FROM long_form) AS nnz, (SELECT CAST(sum(tf) AS BIGINT) FROM long_form) AS total_tf""")
def q_vocab_shape(spark, sf_dir):
    complete, vocab = _vocab(spark, sf_dir)
    vocab = materialize(vocab, "vocabulary")          # read twice, at most max_features rows
    lf = FE.vectorize_long(complete, vocab, "doc_id", "text", DEFAULTS)
    return FE.matrix_shape(lf, complete, vocab)


# ---------------------------------------------------------------- F8 ordinal head
SQL_ORDINAL = """
emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(floor(label / 2) + 1 AS INTEGER) AS label
        FROM embeddings),
sc AS (SELECT vec_id, label,
              list_reduce(list_transform(range(len(x)),
                 lambda j: x[j + 1] * (CAST(((j * 37) % 17) - 8 AS DOUBLE) / CAST(17 AS DOUBLE))),
                 lambda a, b: a + b, CAST(0 AS DOUBLE)) AS score
       FROM emb),
zz AS (SELECT *, score + 1.5::DOUBLE AS z1, score + 0.5::DOUBLE AS z2, score - 0.5::DOUBLE AS z3,
              score - 1.5::DOUBLE AS z4 FROM sc),
sg AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-z1)) AS s1, 1.0::DOUBLE / (1.0::DOUBLE + exp(-z2)) AS s2,
              1.0::DOUBLE / (1.0::DOUBLE + exp(-z3)) AS s3, 1.0::DOUBLE / (1.0::DOUBLE + exp(-z4)) AS s4 FROM zz),
df AS (SELECT *, greatest(1.0::DOUBLE - s1, 0.0::DOUBLE) AS d1, greatest(s1 - s2, 0.0::DOUBLE) AS d2,
              greatest(s2 - s3, 0.0::DOUBLE) AS d3, greatest(s3 - s4, 0.0::DOUBLE) AS d4,
              greatest(s4 - 0.0::DOUBLE, 0.0::DOUBLE) AS d5 FROM sg),
pr AS (SELECT *, d1 / (d1 + d2 + d3 + d4 + d5 + 1e-8::DOUBLE) AS p1, d2 / (d1 + d2 + d3 + d4 + d5 + 1e-8::DOUBLE) AS p2,
              d3 / (d1 + d2 + d3 + d4 + d5 + 1e-8::DOUBLE) AS p3, d4 / (d1 + d2 + d3 + d4 + d5 + 1e-8::DOUBLE) AS p4,
              d5 / (d1 + d2 + d3 + d4 + d5 + 1e-8::DOUBLE) AS p5 FROM df),
ord AS (SELECT *, CAST(1 + (z1 > 0)::INT + (z2 > 0)::INT + (z3 > 0)::INT + (z4 > 0)::INT AS INTEGER) AS rank_class,
               CAST(list_position([p1, p2, p3, p4, p5], greatest(p1, p2, p3, p4, p5)) AS INTEGER) AS argmax_class,
               greatest(p1, p2, p3, p4, p5) AS confidence FROM pr)"""


def _ordinal_columns(df):
    out = [F.col("vec_id"), F.col("label")]
    out += [F.round(F.get("z", k), 6).alias(f"z{k + 1}") for k in range(4)]
    out += [F.round(F.get("p", k), 6).alias(f"p{k + 1}") for k in range(5)]
    out += [O.rank_decode("z").alias("rank_class"), O.argmax_decode("p").alias("argmax_class"),
            F.round(F.array_max("p"), 6).alias("confidence")]
    return df.select(*out)


# M07 M08 M09 M10 L05 P15
@register("ordinal_scores", W(SQL_ORDINAL) + """
SELECT vec_id, label, round(z1, 6) AS z1, round(z2, 6) AS z2, round(z3, 6) AS z3, round(z4, 6) AS z4,
       round(p1, 6) AS p1, round(p2, 6) AS p2, round(p3, 6) AS p3, round(p4, 6) AS p4, round(p5, 6) AS p5,
       rank_class, argmax_class, round(confidence, 6) AS confidence
FROM ord""")
def q_ordinal_scores(spark, sf_dir):
    return _ordinal_columns(EV.fixed_ordinal_scored(spark, sf_dir))


# Prediction table
@register("prediction_table", W(SQL_ORDINAL) + """
SELECT vec_id, label, argmax_class AS predicted, label = argmax_class AS correct,
       round(p1, 6) AS prob_class_1, round(p2, 6) AS prob_class_2, round(p3, 6) AS prob_class_3,
       round(p4, 6) AS prob_class_4, round(p5, 6) AS prob_class_5, round(confidence, 6) AS confidence
FROM ord""")
def q_prediction_table(spark, sf_dir):
    s = EV.fixed_ordinal_scored(spark, sf_dir).withColumn("predicted", O.argmax_decode("p"))
    return s.select("vec_id", "label", "predicted", M.correct_flag().alias("correct"),
                    *[F.round(F.get("p", k), 6).alias(f"prob_class_{k + 1}") for k in range(5)],
                    F.round(F.element_at("p", F.col("predicted")), 6).alias("confidence"))


SQL_WEIGHTED = SQL_ORDINAL + """,
cw AS (SELECT label, count(*) AS n_c, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w
       FROM emb GROUP BY label),
lossrows AS (
  SELECT o.vec_id, o.label, o.score, cw.w,
         cw.w * ((greatest(z1, 0) - z1 * (CASE WHEN o.label - 1 > 0 THEN 1.0 ELSE 0.0 END) + ln(1 + exp(-abs(z1))))
               + (greatest(z2, 0) - z2 * (CASE WHEN o.label - 1 > 1 THEN 1.0 ELSE 0.0 END) + ln(1 + exp(-abs(z2))))
               + (greatest(z3, 0) - z3 * (CASE WHEN o.label - 1 > 2 THEN 1.0 ELSE 0.0 END) + ln(1 + exp(-abs(z3))))
               + (greatest(z4, 0) - z4 * (CASE WHEN o.label - 1 > 3 THEN 1.0 ELSE 0.0 END) + ln(1 + exp(-abs(z4)))))
           AS coral,
         rank_class = o.label AS ok_rank, argmax_class = o.label AS ok_argmax
  FROM ord o JOIN cw ON o.label = cw.label),
soft AS (
  SELECT vec_id, label, w, list_transform(range(1, 6), lambda c: (c - 3) * score) AS s FROM lossrows),
ce AS (
  SELECT vec_id, w, list_max(s) + ln(list_sum(list_transform(s, lambda v: exp(v - list_max(s))))) - s[label] AS nll
  FROM soft)"""


def _weighted_rows(spark, sf_dir):
    s = EV.fixed_ordinal_scored(spark, sf_dir)
    w = P.class_weights(s, "label").select("label", "weight")
    j = s.join(w, "label")
    return (j.withColumn("coral", F.col("weight") * O.coral_row_loss("z", "label", 5))
            .withColumn("soft", F.transform(F.sequence(F.lit(1), F.lit(5)),
                                            lambda c: (c - 3).cast("double") * F.col("score")))
            .withColumn("nll", O.log_softmax_at("soft", "label")))


# M05 M06 M14 J06
@register("ordinal_losses", W(SQL_WEIGHTED) + """
SELECT round((SELECT avg(coral) FROM lossrows), 6) AS coral_loss,
       round((SELECT sum(w * nll) / sum(w) FROM ce), 6) AS ce_loss,
       (SELECT count(*) FROM lossrows) AS n""")
def q_ordinal_losses(spark, sf_dir):
    r = _weighted_rows(spark, sf_dir)
    return r.agg(F.round(F.avg("coral"), 6).alias("coral_loss"),
                 F.round(F.sum(F.col("weight") * F.col("nll")) / F.sum("weight"), 6).alias("ce_loss"),
                 F.count(F.lit(1)).alias("n"))


# M15
@register("epoch_metrics", W(SQL_WEIGHTED) + """
SELECT round(avg(bl), 6) AS loss, count(*) AS n_batches,
       round((SELECT 100.0 * avg(ok_rank::INT) FROM lossrows), 6) AS acc_rank_pct,
       round((SELECT 100.0 * avg(ok_argmax::INT) FROM lossrows), 6) AS acc_argmax_pct
FROM (SELECT vec_id // 32 AS batch, avg(coral) AS bl FROM lossrows GROUP BY 1)""")
def q_epoch_metrics(spark, sf_dir):
    r = _weighted_rows(spark, sf_dir).withColumn("batch", F.floor(F.col("vec_id") / 32))
    r = r.withColumn("ok_rank", (O.rank_decode("z") == F.col("label")).cast("int")) \
         .withColumn("ok_argmax", (O.argmax_decode("p") == F.col("label")).cast("int"))
    per_batch = r.groupBy("batch").agg(F.avg("coral").alias("bl"), F.count(F.lit(1)).alias("bn"),
                                       F.sum("ok_rank").alias("r"), F.sum("ok_argmax").alias("a"))
    return per_batch.agg(F.round(F.avg("bl"), 6).alias("loss"),
                         F.count(F.lit(1)).alias("n_batches"),
                         F.round(100.0 * F.sum("r") / F.sum("bn"), 6).alias("acc_rank_pct"),
                         F.round(100.0 * F.sum("a") / F.sum("bn"), 6).alias("acc_argmax_pct"))


# ---------------------------------------------------------------- A17-A23 A26
SQL_PRED = SQL_CORPUS + ",\n" + SQL_ORDINAL.strip() + """,
pred AS (
  SELECT 'length_rule' AS model, label,
         CAST(CASE WHEN n_chars < 1000 THEN 1 WHEN n_chars < 2500 THEN 2 WHEN n_chars < 5000 THEN 3
                   WHEN n_chars < 10000 THEN 4 ELSE 5 END AS INTEGER) AS predicted FROM corpus
  UNION ALL SELECT 'mod_rule', label, CAST(length(lower(text)) % 4 + 1 AS INTEGER) FROM corpus
  UNION ALL SELECT 'ordinal_fixed', label, argmax_class FROM ord),
cnt AS (SELECT model, label AS y_true, predicted AS y_pred, count(*) AS n FROM pred GROUP BY 1, 2, 3),
labs AS (SELECT model, y_true AS l FROM cnt UNION SELECT model, y_pred FROM cnt),
cm AS (SELECT a.model, a.l AS y_true, b.l AS y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
       FROM labs a JOIN labs b ON a.model = b.model
       LEFT JOIN cnt c ON c.model = a.model AND c.y_true = a.l AND c.y_pred = b.l),
pc AS (SELECT model, y_true AS cls, sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS tp,
              sum(n) AS support FROM cm GROUP BY 1, 2),
pp AS (SELECT model, y_pred AS cls, sum(n) AS predicted FROM cm GROUP BY 1, 2),
m1 AS (SELECT pc.model, pc.cls, tp, support, predicted,
              CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
       FROM pc JOIN pp ON pc.model = pp.model AND pc.cls = pp.cls),
m2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                      ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m1)"""


def _pairs(spark, sf_dir):
    return M.count_pairs(EV.all_predictions(spark, sf_dir))


@register("confusion_matrix", W(SQL_PRED) + "SELECT model, y_true, y_pred, n FROM cm")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(EV.all_predictions(spark, sf_dir))


@register("classification_report", W(SQL_PRED) + """
SELECT model, CAST(cls AS VARCHAR) AS "class", round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM m2
UNION ALL
SELECT model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM m2 GROUP BY model
UNION ALL
SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM m2 GROUP BY model""")
def q_classification_report(spark, sf_dir):
    return M.classification_report(_pairs(spark, sf_dir))


@register("eval_summary", W(SQL_PRED) + """
SELECT model, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
       round(sum(f1 * support) / sum(support), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n
FROM m2 GROUP BY model""")
def q_eval_summary(spark, sf_dir):
    return M.summary(_pairs(spark, sf_dir))


@register("per_class_accuracy", W(SQL_PRED) + """
SELECT model, cls AS label, round(tp / support, 6) AS accuracy, CAST(support AS BIGINT) AS n
FROM m2 WHERE support > 0""")
def q_per_class_accuracy(spark, sf_dir):
    return M.per_class_accuracy(_pairs(spark, sf_dir))


# ---------------------------------------------------------------- W04-W07
SQL_HIST = """
h AS (SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT)
             AS epoch, value AS val_acc FROM events),
b AS (SELECT *, greatest(coalesce(max(val_acc) OVER (PARTITION BY run_id ORDER BY epoch
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0), 0.0) AS best_before FROM h),
i AS (SELECT *, val_acc > best_before AS improved FROM b),
s AS (SELECT *, epoch - coalesce(max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS since FROM i),
st AS (SELECT run_id, min(CASE WHEN since >= 10 THEN epoch END) AS stop_epoch, count(*) AS n FROM s
       GROUP BY run_id)"""


@register("early_stopping", W(SQL_HIST) + """
SELECT s.run_id, st.stop_epoch, CAST(coalesce(st.stop_epoch + 1, st.n) AS BIGINT) AS n_epochs,
       max(CASE WHEN improved AND (st.stop_epoch IS NULL OR epoch <= st.stop_epoch) THEN epoch END) AS best_epoch,
       max(CASE WHEN improved AND (st.stop_epoch IS NULL OR epoch <= st.stop_epoch) THEN val_acc END)
         AS best_val_acc
FROM s JOIN st ON s.run_id = st.run_id GROUP BY s.run_id, st.stop_epoch, st.n""")
def q_early_stopping(spark, sf_dir):
    return H.early_stopping(H.from_events(T.table(spark, sf_dir, "events")))


@register("lr_schedule", "WITH RECURSIVE " + SQL_HIST.strip() + """,
hh AS (SELECT s.run_id, s.epoch, s.val_acc FROM s JOIN st ON s.run_id = st.run_id
       WHERE st.stop_epoch IS NULL OR s.epoch <= st.stop_epoch),
r AS (
  SELECT run_id, epoch, val_acc AS best, 0 AS bad, CAST(0.002 AS DOUBLE) AS lr_in,
         CAST(0.002 AS DOUBLE) AS lr_out FROM hh WHERE epoch = 0
  UNION ALL
  SELECT n.run_id, n.epoch,
         CASE WHEN n.val_acc > r.best * CAST(1.0001 AS DOUBLE) THEN n.val_acc ELSE r.best END,
         CASE WHEN n.val_acc > r.best * CAST(1.0001 AS DOUBLE) THEN 0 WHEN r.bad + 1 > 3 THEN 0
              ELSE r.bad + 1 END,
         r.lr_out,
         CASE WHEN NOT (n.val_acc > r.best * CAST(1.0001 AS DOUBLE)) AND r.bad + 1 > 3
                   AND r.lr_out - r.lr_out * 0.5 > CAST(1e-8 AS DOUBLE)
              THEN r.lr_out * 0.5 ELSE r.lr_out END
  FROM r JOIN hh n ON n.run_id = r.run_id AND n.epoch = r.epoch + 1)
SELECT run_id, epoch, lr_in AS lr FROM r""")
def q_lr_schedule(spark, sf_dir):
    return H.lr_schedule(H.from_events(T.table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- P01-P07 (F1)
def annotation_records(corpus):
    """Fixture F1: every labelled document as an annotation record, in one of
    four shapes (by doc_id mod 4): data.text + choice '<y> - x'; text +
    array choice [y, '9']; content + choice 'y'; only a fallback string field
    after a blank one + choice 'y'."""
    y = F.col("label").cast("string")

    def ann(choice):
        return F.array(F.struct(F.array(F.struct(F.struct(F.array(choice).alias("choices"))
                                                 .alias("value"))).alias("result")))
    shape = F.col("doc_id") % 4
    r0 = F.to_json(F.struct(F.struct(F.col("text").alias("text")).alias("data"),
                            ann(F.concat(y, F.lit(" - x"))).alias("annotations")))
    r1 = F.to_json(F.struct(F.col("text").alias("text"),
                            ann(F.array(y, F.lit("9"))).alias("annotations")))
    r2 = F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("content"),
                            ann(y).alias("annotations")))
    r3 = F.to_json(F.struct(F.col("doc_id").alias("id"), F.lit(" ").alias("meta"),
                            F.col("text").alias("body"), ann(y).alias("annotations")))
    rec = F.when(shape == 0, r0).when(shape == 1, r1).when(shape == 2, r2).otherwise(r3)
    return corpus.select("doc_id", rec.alias("rec"))


@register("json_extract", W(SQL_CORPUS) + """
SELECT doc_id, text, label FROM corpus WHERE text IS NOT NULL AND text <> '' AND label IS NOT NULL""")
def q_json_extract(spark, sf_dir):
    from annolab.functions.extract import extract_records, keep_labelled_text
    recs = extract_records(annotation_records(T.corpus(spark, sf_dir, heavy=True)))
    return keep_labelled_text(recs).select("doc_id", "text", "label")
