"""Registered model queries: scoring with given weights (exact oracles), fits
(row counts and the closed-form loss of a constant predictor against the fitted
loss), comparisons of models, the hashing encoder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from annolab.config import DEFAULTS
from annolab.functions import ordinal as O
from annolab.operators import compare as CMP
from annolab.operators import features as FE
from annolab.operators import history as H
from annolab.operators import metrics as M
from annolab.operators import mlp as NN
from annolab.operators import models as MD
from annolab.operators import numbering as N
from annolab.operators import profile as P
from annolab.operators import split as S
from annolab.operators import training as TR
from annolab.operators.embed import hashing_embed
from annolab.plans import evaluation as EV
from annolab.plans.catalog import dataset, register
from annolab.plans.queries_profile import SQL_CORPUS, SQL_DOC_TERMS, SQL_SPLIT, W, _vocab
from annolab.session import materialize, spread
from annolab.sources import testdata as T

SQL_SIGNAL = """
sig AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x,
               CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE) AS s FROM embeddings),
lab AS (SELECT vec_id, x, CAST(1 + (s > -0.2::DOUBLE)::INT + (s > -0.06::DOUBLE)::INT + (s > 0.06::DOUBLE)::INT
                               + (s > 0.2::DOUBLE)::INT AS INTEGER) AS label FROM sig)"""


# ---------------------------------------------------------------- M02 M03
def fixed_coefficient(idx, cls):
    """Fixture: coefficient of vocabulary entry idx for class cls (1-based)."""
    return (((idx * 31 + cls * 17) % 23) - 11).cast("double") / 11.0


@register("baseline_scores", "WITH " + SQL_DOC_TERMS + """,
z AS (SELECT c.doc_id, k.k, coalesce(sum(l.tf * CAST((l.idx * 31 + k.k * 17) % 23 - 11 AS DOUBLE) / 11.0::DOUBLE), 0.0)
             / 64.0::DOUBLE AS z
      FROM complete c CROSS JOIN (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS k) k
      LEFT JOIN long_form l ON l.doc_id = c.doc_id GROUP BY c.doc_id, k.k),
m AS (SELECT *, max(z) OVER (PARTITION BY doc_id) AS top FROM z),
p AS (SELECT doc_id, k, exp(z - top) / sum(exp(z - top)) OVER (PARTITION BY doc_id) AS p FROM m)
SELECT doc_id, CAST(arg_max(k, round(p, 9) - k * 1e-12) AS INTEGER) AS predicted, round(max(p), 6) AS confidence
FROM p GROUP BY doc_id""")
def q_baseline_scores(spark, sf_dir):
    """Bag-of-words softmax scores with fixed coefficients over the fitted vocabulary."""
    complete, vocab = _vocab(spark, sf_dir)
    lf = FE.vectorize_long(complete, vocab, "doc_id", "text", DEFAULTS)
    sums = lf.groupBy("doc_id").agg(*[F.sum(F.col("tf") * fixed_coefficient(F.col("idx"), F.lit(k))).alias(f"z{k}")
                                      for k in range(1, 6)])
    z = complete.select("doc_id").join(sums, "doc_id", "left").select("doc_id", F.array(
        *[F.coalesce(F.col(f"z{k}"), F.lit(0.0)) / 64.0 for k in range(1, 6)]).alias("z"))
    e = z.withColumn("e", F.transform("z", lambda v: F.exp(v - F.array_max("z"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    p = e.withColumn("p", F.transform("e", lambda v: v / total))
    rounded = F.transform("p", lambda v: F.round(v, 9))
    return p.select("doc_id", O.argmax_decode(rounded).alias("predicted"),
                    F.round(F.array_max("p"), 6).alias("confidence"))


# ---------------------------------------------------------------- M04
@register("embed_hash", """
WITH tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM documents),
g AS (SELECT doc_id, unnest(list_concat(t, CASE WHEN len(t) >= 2
        THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END)) AS gram FROM tok),
h AS (SELECT doc_id, md5(gram) AS h FROM g),
b AS (SELECT doc_id, CAST(('0x' || substring(h, 1, 8))::BIGINT % 64 AS INTEGER) AS bucket,
             CAST(sum(CASE WHEN ('0x' || substring(h, 9, 1))::BIGINT % 2 = 1 THEN -1 ELSE 1 END) AS DOUBLE) AS v
      FROM h GROUP BY 1, 2),
n AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM b GROUP BY 1)
SELECT b.doc_id, b.bucket, round(v / norm, 6) AS value FROM b JOIN n ON b.doc_id = n.doc_id WHERE v <> 0""")
def q_embed_hash(spark, sf_dir):
    e = hashing_embed(T.table(spark, sf_dir, "documents", heavy=True).select("doc_id", "text"))
    return (e.select("doc_id", F.posexplode("embedding").alias("bucket", "value")).where("value <> 0")
            .select("doc_id", "bucket", F.round("value", 6).alias("value")))


# ---------------------------------------------------------------- M12 (scoring)
def fixed_network(ordinal: bool = True) -> NN.Network:
    """Fixture: 64 -> 4 (relu) -> ordinal head, weights from a formula."""
    j, u = np.arange(64)[:, None], np.arange(4)[None, :]
    w = ((j * 7 + u * 5) % 13 - 6) / 6.0
    return NN.Network([(w, np.arange(4) * 0.1 - 0.15)], (np.array([0.8, -0.6, 0.5, -0.3]),
                                                         np.array([1.0, 0.3, -0.3, -1.0])), ordinal)


@register("mlp_scores", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
h AS (SELECT vec_id, list_transform(range(0, 4), lambda u: greatest(0.0::DOUBLE,
        list_sum(list_transform(range(0, 64), lambda j: x[j + 1] * CAST((j * 7 + u * 5) % 13 - 6 AS DOUBLE) / 6.0::DOUBLE))
        + u * 0.1::DOUBLE - 0.15::DOUBLE)) AS h FROM e),
s AS (SELECT vec_id, 0.8::DOUBLE * h[1] - 0.6::DOUBLE * h[2] + 0.5::DOUBLE * h[3] - 0.3::DOUBLE * h[4] AS s FROM h),
q AS (SELECT vec_id, 1 / (1 + exp(-(s + 1.0::DOUBLE))) AS a, 1 / (1 + exp(-(s + 0.3::DOUBLE))) AS b,
             1 / (1 + exp(-(s - 0.3::DOUBLE))) AS c, 1 / (1 + exp(-(s - 1.0::DOUBLE))) AS d FROM s),
p AS (SELECT vec_id, [1 - a, a - b, b - c, c - d, d] AS p FROM q)
SELECT vec_id, CAST(list_position(p, list_max(p)) AS INTEGER) AS predicted,
       round(list_max(p) / (1 + 1e-8::DOUBLE), 6) AS confidence FROM p""")
def q_mlp_scores(spark, sf_dir):
    e = T.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return fixed_network().transform(e).select("vec_id", "predicted", F.round("confidence", 6).alias("confidence"))


# ---------------------------------------------------------------- fits
@register("baseline_fit", "WITH " + SQL_SPLIT.strip() + """,
f AS (SELECT label FROM complete WHERE split IN ('train', 'val'))
SELECT (SELECT count(*) FROM f) AS n_fit, (SELECT count(*) FROM complete WHERE split = 'test') AS n_test,
       round(ln((SELECT count(DISTINCT label) FROM f)), 6) AS constant_loss, TRUE AS beats_constant,
       TRUE AS beats_chance""")
def q_baseline_fit(spark, sf_dir):
    """Fit the bag-of-words logistic regression on train + val, score all.
    With balanced weights a constant predictor has the loss ln K and is right once in K;
    the fit must be below that loss on the fit rows, and right more often on the consensus
    test rows."""
    complete = spread(dataset(spark, sf_dir)[1].complete)
    fit = complete.filter(F.col("split").isin("train", "val"))
    model = MD.fit_baseline(fit, "text", "label", DEFAULTS)
    scored = materialize(model.transform(complete.select("doc_id", "text", "label", "split"))
                         .select("label", "split", "predicted", "probs"), "scored")
    train = MD.with_class_weights(scored.where("split <> 'test'"))
    loss = train.agg(F.sum(F.col("weight") * -F.log(F.element_at("probs", F.col("label")))) / F.sum("weight")).scalar()
    k = train.agg(F.log(F.countDistinct("label").cast("double"))).scalar()
    right = F.avg(F.when(F.col("split") == "test", M.correct_flag().cast("double")))
    return scored.agg(F.count(F.when(F.col("split") != "test", 1)).alias("n_fit"),
                      F.count(F.when(F.col("split") == "test", 1)).alias("n_test"), right.alias("right")).select(
        "n_fit", "n_test", F.round(k, 6).alias("constant_loss"), (loss < k).alias("beats_constant"),
        (F.col("right") > F.exp(-k)).alias("beats_chance"))


SQL_CONSTANT = """
k AS (SELECT label, count(*) AS n FROM lab GROUP BY label),
kk AS (SELECT count(*) AS classes, sum(n) AS n FROM k),
lv AS (SELECT level, (SELECT count(*) FROM k WHERE label - 1 > level) / CAST((SELECT classes FROM kk) AS DOUBLE) AS p
       FROM (SELECT unnest(range(0, 4)) AS level)),
c AS (SELECT sum(CASE WHEN p IN (0, 1) THEN 0 ELSE -p * ln(p) - (1 - p) * ln(1 - p) END) AS loss FROM lv)"""


@register("ordinal_fit", W(SQL_SIGNAL, SQL_CONSTANT) + """
SELECT CAST((SELECT n FROM kk) AS BIGINT) AS n, round((SELECT loss FROM c), 6) AS constant_loss,
       TRUE AS beats_constant, TRUE AS biases_ordered""")
def q_ordinal_fit(spark, sf_dir):
    """M11 on labels that the vectors decide: with balanced weights the best constant
    predictor's CORAL loss is a sum of binary entropies; the fit must be below half."""
    e = T.signal_embeddings(spark, sf_dir)
    model = MD.fit_ordinal(e, "embedding", "label", DEFAULTS)
    loss = MD.ordinal_loss(model.transform(e))
    k = P.class_weights(e, "label").agg(F.collect_list("label").alias("labels"))
    entropy = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda lv: F.size(
        F.filter("labels", lambda c: c - 1 > lv)) / F.size("labels")), F.lit(0.0), lambda a, p: a + F.when(
            (p == 0) | (p == 1), 0.0).otherwise(-p * F.log(p) - (1 - p) * F.log(1 - p)))
    constant = k.select(entropy).scalar()
    ordered = all(a >= b for a, b in zip(model.b, model.b[1:]))
    return loss.select("n", F.round(constant, 6).alias("constant_loss"),
                       (F.col("loss") < constant / 2).alias("beats_constant"), F.lit(ordered).alias("biases_ordered"))


# the labelled vectors, split by class as W01 does
SQL_SIGNAL_SPLIT = SQL_SIGNAL + ",\nkept AS (SELECT vec_id AS doc_id, label FROM lab),\n" \
    + SQL_SPLIT[SQL_SPLIT.index("cls AS ("):SQL_SPLIT.index("split AS (")] + """
parts AS (SELECT r.doc_id AS vec_id, r.label, CASE WHEN r.rk <= q.quota THEN 'val' ELSE 'train' END AS split
          FROM ranked r JOIN quota q ON r.label = q.label)"""
SQL_NETWORK = W(SQL_SIGNAL_SPLIT) + """
SELECT CAST(sum(CASE WHEN split = 'train' THEN c END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN split = 'val' THEN c END) AS BIGINT) AS n_val,
       round(max(CASE WHEN split = 'val' THEN c END) / CAST(sum(CASE WHEN split = 'val' THEN c END) AS DOUBLE), 6) AS majority,
       TRUE AS beats_majority, TRUE AS kept_first_best, TRUE AS ended_at_stop, TRUE AS kept_scores_best
FROM (SELECT split, label, count(*) AS c FROM parts GROUP BY 1, 2)"""


def _network_row(spark, sf_dir, ordinal):
    """The network of Settings' size fitted on train and validated on val after each epoch
    (S11, W05, W07): the kept weights are those of the first best epoch, the history ends where
    ``early_stopping`` ends it, the kept network scores the best accuracy on val again, which is
    at least 0.2 above the share of val's largest class."""
    e = T.signal_embeddings(spark, sf_dir)
    rows = materialize(S.stratified_split(e, "label", "vec_id", DEFAULTS.val_fraction, DEFAULTS.seed), "signal-split")
    run = TR.fit_validated(rows, "embedding", "label", DEFAULTS, ordinal=ordinal)
    stop = H.early_stopping(run.history(spark, "run")).first()
    val = run.best.transform(rows.where("split = 'val'"))
    hit = val.agg(F.avg(M.correct_flag().cast("double"))).scalar()
    counts = rows.groupBy("split", "label").agg(F.count("*").alias("c"))
    of = {s: F.when(F.col("split") == s, F.col("c")) for s in ("train", "val")}
    return counts.agg(F.sum(of["train"]).alias("n_train"), F.sum(of["val"]).alias("n_val"),
                      (F.max(of["val"]) / F.sum(of["val"])).alias("m")).select(
        "n_train", "n_val", F.round("m", 6).alias("majority"), (hit > F.col("m") + 0.2).alias("beats_majority"),
        F.lit(stop.best_epoch == run.best_epoch).alias("kept_first_best"),
        F.lit(stop.n_epochs == len(run.curves)).alias("ended_at_stop"),
        (F.abs(100.0 * hit - F.lit(stop.best_val_acc)) < 1e-6).alias("kept_scores_best"))


@register("mlp_fit", SQL_NETWORK)
def q_mlp_fit(spark, sf_dir):
    """Hidden layers plus ordinal head."""
    return _network_row(spark, sf_dir, True)


@register("mlp_softmax_fit", SQL_NETWORK)
def q_mlp_softmax_fit(spark, sf_dir):
    """MultilayerPerceptronClassifier."""
    return _network_row(spark, sf_dir, False)


# ---------------------------------------------------------------- L06 M15: shuffled batches and their means
SQL_EPOCHS = SQL_SIGNAL + """,
ep AS (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS epoch),
numbered AS (SELECT epoch, vec_id, row_number() OVER (PARTITION BY epoch
               ORDER BY md5('42:' || CAST(epoch AS VARCHAR) || ':' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS place FROM lab, ep),
batched AS (SELECT epoch, CAST(place // 32 AS BIGINT) AS batch, vec_id AS row_id, place FROM numbered)"""


@register("epoch_batches", W(SQL_EPOCHS) + " SELECT epoch, batch, row_id FROM batched")
def q_epoch_batches(spark, sf_dir):
    return N.epoch_batches(T.signal_embeddings(spark, sf_dir), 3, "vec_id").select("epoch", "batch", "row_id")


@register("epoch_batch_means", W(SQL_EPOCHS) + """
SELECT epoch, count(*) AS n_batches, CAST(sum(n) AS BIGINT) AS n, round(avg(m), 6) AS mean
FROM (SELECT epoch, batch, avg(CAST(label AS DOUBLE) * s) AS m, count(*) AS n FROM batched JOIN
      (SELECT sig.vec_id, label, sig.s FROM sig JOIN lab ON sig.vec_id = lab.vec_id) v ON v.vec_id = row_id GROUP BY 1, 2) GROUP BY 1""")
def q_epoch_batch_means(spark, sf_dir):
    """The mean of the batches' means of a value per row (label times the deciding sum)."""
    e = materialize(T.signal_embeddings(spark, sf_dir), "signal")
    scored = e.select("vec_id", (F.col("label") * (F.get("embedding", 0) + F.get("embedding", 1))).alias("v"))
    got = N.epoch_means(scored, N.epoch_batches(e, 3, "vec_id"), "v", "vec_id")
    return got.withColumn("mean", F.round("mean", 6))


# ---------------------------------------------------------------- U02: the combined table re-indexed
@register("complete_index", "WITH " + SQL_SPLIT.strip() + """
SELECT doc_id, split, row_number() OVER (ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 WHEN 'test' THEN 2 ELSE 3 END,
                                         doc_id) - 1 AS index FROM complete""")
def q_complete_index(spark, sf_dir):
    return N.reindexed(dataset(spark, sf_dir)[1].complete.select("doc_id", "split"))


# ---------------------------------------------------------------- M16 J04 U04 A24 P10 P17
SQL_RULES_DOCS = """
rd AS (SELECT doc_id, text,
              CAST(CASE WHEN n_chars < 1000 THEN 1 WHEN n_chars < 2500 THEN 2 WHEN n_chars < 5000 THEN 3
                        WHEN n_chars < 10000 THEN 4 ELSE 5 END AS INTEGER) AS length_rule_prediction,
              CAST(length(lower(text)) % 4 + 1 AS INTEGER) AS mod_rule_prediction
       FROM documents)"""


def _rules(spark, sf_dir):
    docs = T.table(spark, sf_dir, "documents")
    none = F.lit(None).cast("double")
    return CMP.agreement(CMP.score_columns(docs, {"length_rule": (EV.length_rule(docs), none),
                                                  "mod_rule": (EV.mod_rule(), none)}))


@register("model_agreement", W(SQL_RULES_DOCS) + """
SELECT doc_id, CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS preview,
       length_rule_prediction, mod_rule_prediction,
       length_rule_prediction = mod_rule_prediction AS agree,
       'length_rule: ' || CAST(length_rule_prediction AS VARCHAR) || ', mod_rule: '
         || CAST(mod_rule_prediction AS VARCHAR) AS detail
FROM rd""")
def q_model_agreement(spark, sf_dir):
    return _rules(spark, sf_dir).select("doc_id", P.truncate("text").alias("preview"), "length_rule_prediction",
                                        "mod_rule_prediction", "agree", "detail")


@register("agreement_rate", W(SQL_RULES_DOCS) + """
SELECT count(*) AS n, CAST(sum(CAST(length_rule_prediction = mod_rule_prediction AS INTEGER)) AS BIGINT) AS n_agree,
       round(avg(CAST(length_rule_prediction = mod_rule_prediction AS DOUBLE)) * 100.0, 1) AS agree_pct
FROM rd""")
def q_agreement_rate(spark, sf_dir):
    return CMP.agreement_rate(_rules(spark, sf_dir))


# separately stored outputs, pivoted: rules over documents against a rule over labels
@register("inference_compare", W(SQL_CORPUS) + """,
a AS (SELECT doc_id, CAST(length(lower(text)) % 4 + 1 AS INTEGER) AS p FROM documents)
SELECT a.doc_id, a.p AS mod_rule_prediction, c.label AS rated_prediction,
       a.p IS NOT DISTINCT FROM c.label AS agree
FROM a LEFT JOIN corpus c ON a.doc_id = c.doc_id""")
def q_inference_compare(spark, sf_dir):
    docs = T.table(spark, sf_dir, "documents")
    one = F.lit(1.0).alias("confidence")
    scored = {"mod_rule": docs.select("doc_id", EV.mod_rule().alias("predicted"), one),
              "rated": T.corpus(spark, sf_dir).select("doc_id", F.col("label").alias("predicted"), one),
              "absent": None}
    long = CMP.long_predictions(scored)
    wide = CMP.wide_predictions(long, [m for m, df in scored.items() if df is not None])
    return CMP.agreement(wide).select("doc_id", "mod_rule_prediction", "rated_prediction", "agree")


# a model's inference over every text: embedded, scored by an ordinal head, compared with a rule
@register("inference_models", """
WITH tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM documents),
g AS (SELECT doc_id, unnest(list_concat(t, CASE WHEN len(t) >= 2
        THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END)) AS gram FROM tok),
h AS (SELECT doc_id, md5(gram) AS h FROM g),
b AS (SELECT doc_id, CAST(('0x' || substring(h, 1, 8))::BIGINT % 64 AS INTEGER) AS bucket,
             CAST(sum(CASE WHEN ('0x' || substring(h, 9, 1))::BIGINT % 2 = 1 THEN -1 ELSE 1 END) AS DOUBLE) AS v
      FROM h GROUP BY 1, 2),
e AS (SELECT doc_id, sum(v * ((bucket * 37) % 17 - 8) / 17.0::DOUBLE) / greatest(sqrt(sum(v * v)), 1e-300::DOUBLE) AS s
      FROM b GROUP BY 1),
s AS (SELECT d.doc_id, d.n_chars, coalesce(e.s, 0.0::DOUBLE) AS s FROM documents d LEFT JOIN e ON d.doc_id = e.doc_id),
q AS (SELECT *, 1 / (1 + exp(-(s + 1.5::DOUBLE))) AS a, 1 / (1 + exp(-(s + 0.5::DOUBLE))) AS b,
             1 / (1 + exp(-(s - 0.5::DOUBLE))) AS c, 1 / (1 + exp(-(s - 1.5::DOUBLE))) AS d FROM s),
p AS (SELECT doc_id, [1 - a, a - b, b - c, c - d, d] AS p,
             CAST(CASE WHEN n_chars < 1000 THEN 1 WHEN n_chars < 2500 THEN 2 WHEN n_chars < 5000 THEN 3
                       WHEN n_chars < 10000 THEN 4 ELSE 5 END AS INTEGER) AS length_rule_prediction FROM q),
m AS (SELECT *, CAST(list_position(p, list_max(p)) AS INTEGER) AS k FROM p)
SELECT doc_id, length_rule_prediction, k AS ordinal_hashed_prediction,
       round(list_max(p) / (1 + 1e-8::DOUBLE), 6) AS ordinal_hashed_confidence, length_rule_prediction = k AS agree
FROM m""")
def q_inference_models(spark, sf_dir):
    """M04 + M16: every document embedded by the hashing encoder, scored by the fixed
    ordinal head and by the length rule (which has no confidence), compared row by row."""
    docs = T.table(spark, sf_dir, "documents", heavy=True).select("doc_id", "text", "n_chars")
    head = MD.OrdinalModel(EV.fixed_weights(DEFAULTS.embedding_dim), list(EV.FIXED_BIASES), DEFAULTS.num_classes)
    scored = head.transform(hashing_embed(docs))
    wide = CMP.score_columns(scored, {"length_rule": (EV.length_rule(scored), F.lit(None).cast("double")),
                                      "ordinal_hashed": (F.col("predicted"), F.col("confidence"))})
    return CMP.agreement(wide).select("doc_id", "length_rule_prediction", "ordinal_hashed_prediction",
                                      F.round("ordinal_hashed_confidence", 6).alias("ordinal_hashed_confidence"), "agree")
