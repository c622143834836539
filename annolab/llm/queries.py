"""The dealt operators as queries: ``opN_name(spark, sf_dir)`` applies an operator,
with its default parameters, to the whole of its tables. Where DuckDB SQL can say the same,
it stands beside the query; the others are tested in tests/llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolab.llm import (alignment, common, debruijn, decontaminate, hmm, langid, minhash, parsing, periodic,
                         pieces, pii, quality, topk, vectors)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with DuckDB SQL for the same rows where there is any."""
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(r"""WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bp AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, least(len(w), 10) AS k FROM bw WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM bp),
sizes AS (SELECT DISTINCT k FROM pat),
win AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(w) >= k)),
hit AS (SELECT win.doc_id, win.k, win.i, pat.item_id FROM win JOIN pat ON win.k = pat.k AND win.p = pat.p),
pos AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id""")
def op1_decontaminate(spark, sf_dir):
    return decontaminate.digest(decontaminate.find_contamination(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark")))


@query()
def op2_pii(spark, sf_dir):
    return pii.digest(pii.find(documents(spark, sf_dir)))


@query()
def op3_quality(spark, sf_dir):
    ratings = table(spark, sf_dir, "labels").select("doc_id", quality.grade_of().alias("grade"))
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, ratings)).select("doc_id", "expected_grade", "p_tail", "keep")


@query()
def op4_pieces(spark, sf_dir):
    """ids_sha256: of the ids as comma-joined text; round_trip: decoding gives the text."""
    model = pieces.read_model()
    encoded = pieces.encode(documents(spark, sf_dir), model)
    return pieces.decode(encoded, model).select(
        "doc_id", "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query()
def op5_hmm(spark, sf_dir):
    return hmm.score(documents(spark, sf_dir))


@query()
def op6_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    train = docs.where(common.crc_mod("doc_id", 4) != 2).select("doc_id", "text", "lang")
    out = langid.identify(docs.select("doc_id", "text"), langid.dictionaries(train))
    return out.select("doc_id", F.coalesce(common.crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "rejected")


@query(r"""WITH dw AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS p
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM dw WHERE len(w) >= 13)),
first AS (SELECT p, min(doc_id) AS d FROM win GROUP BY p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM win JOIN first ON win.p = first.p WHERE doc_id > d),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM dw),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.j) AS t, count(*) AS n FROM word LEFT JOIN gone
         ON word.doc_id = gone.doc_id AND word.j = gone.j WHERE gone.j IS NULL GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM dw LEFT JOIN kept ON dw.doc_id = kept.doc_id""")
def op7_debruijn(spark, sf_dir):
    return debruijn.dedup(documents(spark, sf_dir), finish=debruijn.digest)


@query(r"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS p
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
first AS (SELECT p, min(doc_id) AS f FROM win GROUP BY p),
hit AS (SELECT win.doc_id, i, lag(i) OVER (PARTITION BY win.doc_id ORDER BY i) AS before
        FROM win JOIN first ON win.p = first.p WHERE win.doc_id > f),
part AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hit),
run AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM part GROUP BY doc_id, g),
gap AS (SELECT run.*, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS pb FROM run),
kept AS (SELECT d.doc_id, string_agg(substring(h, 2 * pb + 1, 2 * (a - pb)), '' ORDER BY a)
                || substring(any_value(h), 2 * max(b) + 1) AS k, sum(b - a) AS r, count(*) AS spans
         FROM gap JOIN d ON d.doc_id = gap.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""")
def op8_parsing(spark, sf_dir):
    return parsing.dedup(documents(spark, sf_dir), finish=parsing.digest)


@query(r"""WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON reach.r = a),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT comp.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, comp.doc_id = component_id AS kept
FROM comp LEFT JOIN n ON n.doc_id = comp.doc_id""")
def op9_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


@query(r"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op10_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query()
def op11_alignment(spark, sf_dir):
    return alignment.link_statistics(documents(spark, sf_dir))


@query(r"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             CAST(doc_id AS VARCHAR) AS s FROM documents),
crc AS (SELECT *, len(w) AS n, xor(4294967295, list_reduce(list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substring(s, i, 1)) AS BIGINT)),
          lambda c, b: list_reduce(range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
          CAST(4294967295 AS BIGINT))) AS h FROM d),
beg AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM crc),
per AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM beg),
t AS (SELECT k, doc_id, n, list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) AS w FROM per),
g AS (SELECT k, n, i, array_to_string(w[i + 1:i + 5], ' ') AS s FROM (SELECT k, n, w, unnest(range(0, n - 4)) AS i FROM t WHERE n >= 6)),
eq AS (SELECT x.k, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.k = y.k AND x.s = y.s AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isl AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS z FROM eq),
per_run AS (SELECT k, q, min(i) AS s, count(*) + 4 + q AS n FROM isl GROUP BY k, q, z HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM per_run r WHERE NOT EXISTS (SELECT 1 FROM per_run o WHERE o.k = r.k AND o.q < r.q AND o.s <= r.s AND o.s + o.n >= r.s + r.n)),
top AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n / q DESC, s, q) AS z FROM runs),
txt AS (SELECT k, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS r FROM runs GROUP BY k),
gone AS (SELECT DISTINCT k, unnest(range(s + q, s + n)) AS i FROM runs),
word AS (SELECT k, unnest(w) AS x, unnest(range(0, n)) AS i FROM t),
kept AS (SELECT word.k, string_agg(x, ' ' ORDER BY word.i) AS c FROM word LEFT JOIN gone ON gone.k = word.k AND gone.i = word.i
         WHERE gone.i IS NULL GROUP BY word.k)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.n AS length, top.q AS period, 1000 * top.n // top.q AS exponent_milli,
       sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM t LEFT JOIN txt ON txt.k = t.k LEFT JOIN top ON top.k = t.k AND top.z = 1 LEFT JOIN kept ON kept.k = t.k""")
def op12_periodic(spark, sf_dir):
    return periodic.digest(periodic.periodic_runs(documents(spark, sf_dir)))


@query(r"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.k AS a, y.k AS b FROM ok x JOIN ok y ON x.label = y.label AND len(x.e) = len(y.e) AND x.k <> y.k
          AND list_cosine_similarity(x.e, y.e) >= 0.98),
reach AS (SELECT k, k AS r FROM v UNION SELECT reach.k, b FROM reach JOIN links ON reach.r = a),
comp AS (SELECT reach.k, min(v.vec_id) AS component_id FROM reach JOIN v ON v.k = reach.r GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, component_id, coalesce(v.vec_id = component_id, true) AS kept
FROM v JOIN comp ON comp.k = v.k LEFT JOIN n ON n.a = v.k""")
def op13_vectors(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
