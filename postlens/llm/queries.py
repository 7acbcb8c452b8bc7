"""The registered queries of the subpackage: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.bpe import bpe_decode, bpe_encode, load_vocabulary
from postlens.llm.centroid_clustering import centroid_clusters
from postlens.llm.chat_format import chat_messages
from postlens.llm.decontaminate import contaminated
from postlens.llm.embedding_dedup import embedding_groups
from postlens.llm.fingerprints import document_fingerprints
from postlens.llm.minhash import minhash_groups
from postlens.llm.periodic_runs import periodic_runs, planted
from postlens.llm.resampling import importance_resample
from postlens.llm.sharding import balanced, grown, hash_tree_shards
from postlens.llm.suffix_dedup import suffix_dedup
from postlens.llm.toxicity import toxicity
from postlens.llm.url_filter import url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_OP7_SQL = """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, p, b[p:p + 99] AS s FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS p FROM t)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w)
          WHERE k > 1),
-- islands of removed bytes: starts at most 100 apart touch or overlap
isle AS (SELECT doc_id, p, sum(far) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM (
           SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS far
           FROM again)),
span AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS e FROM isle GROUP BY doc_id, g),
cut AS (SELECT doc_id, a, e, lag(e, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM span),
kept AS (SELECT c.doc_id, count(*) AS n_spans, sum(c.e - c.a) AS n_removed, max(c.e) AS tail,
           string_agg(hex(t.b[c.before:c.a - 1]), '' ORDER BY c.a) AS h
         FROM cut c JOIN t USING (doc_id) GROUP BY c.doc_id)
SELECT t.doc_id, octet_length(t.b)::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  coalesce(k.n_spans, 0)::BIGINT AS n_spans,
  CASE WHEN k.doc_id IS NULL THEN sha256(t.b)
       ELSE sha256(unhex(coalesce(k.h, '') || hex(t.b[k.tail:octet_length(t.b)]))) END AS kept_sha256
FROM t LEFT JOIN kept k USING (doc_id)"""


@_query("op7_suffix_dedup", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(spark, docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query("op1_minhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_groups(spark, docs, size=2, per_cent=80).drop("tie", "first")


@_query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = load_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe_encode(spark, docs, vocabulary).select("doc_id", "ids")
    return bpe_decode(spark, ids, vocabulary).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(spark, docs, _read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@_query("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(spark, docs, _read(spark, sf_dir, "benchmark")).drop("tie")


@_query("op3_hash_tree_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = balanced(8)
    return hash_tree_shards(spark, _read(spark, sf_dir, "documents").select("doc_id", "text"), tree, grown(tree))


@_query("op9_importance_resample")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_resample(spark, docs, _read(spark, sf_dir, "labels")).where("kept").select("doc_id", "n_grams", "log_weight", "key")


_OP6_SQL = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
           AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (WITH RECURSIVE r(u, v) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, l.v FROM r JOIN link l ON r.v = l.u)
          SELECT u, min(v) AS low FROM r GROUP BY u)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE u = e.vec_id)::BIGINT AS n_links, r.low AS component_id, e.vec_id = r.low AS kept
FROM embeddings e JOIN reach r ON r.u = e.vec_id"""


@_query("op6_embedding_dedup", _OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(spark, _read(spark, sf_dir, "embeddings"), 0.98)


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}

_OP5_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS text FROM pages),
r AS (SELECT page_id, text, CASE WHEN instr(text, '://') > 0 THEN substr(text, instr(text, '://') + 3) ELSE '' END AS rest FROM p),
h AS (SELECT page_id, text, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rule, dom, pre, word) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
-- one row a page, so that repeated page_ids stay apart
n AS (SELECT *, row_number() OVER () AS k FROM h),
f AS (SELECT n.k, arg_max(rule, length(rule)) AS rule, arg_max(word, length(rule)) AS word FROM n JOIN rules
      ON (host = dom OR ends_with(host, '.' || dom)) AND starts_with(path, pre) GROUP BY n.k),
m AS (SELECT n.*, f.rule, f.word FROM n LEFT JOIN f USING (k)),
u AS (SELECT text, min(word) AS word FROM m GROUP BY text),
g AS (SELECT text, word, substr(repeat(chr(2), 3) || text || chr(3), i, 4) AS g4 FROM (SELECT text, word, unnest(range(1, length(text) + 2)) AS i FROM u)),
t4 AS (SELECT g4 AS g, count(*) FILTER (word = 'allow') AS a, count(*) FILTER (word = 'block') AS b FROM g GROUP BY g4),
t3 AS (SELECT substr(g, 2) AS g, sum(a) AS a, sum(b) AS b FROM t4 GROUP BY 1),
t2 AS (SELECT substr(g, 2) AS g, sum(a) AS a, sum(b) AS b FROM t3 GROUP BY 1),
t1 AS (SELECT substr(g, 2) AS g, sum(a) AS a, sum(b) AS b FROM t2 GROUP BY 1),
p1 AS (SELECT g, (a + 4.0::DOUBLE / 256) / ((SELECT sum(a) FROM t1) + 4.0::DOUBLE) AS pa, (b + 4.0::DOUBLE / 256) / ((SELECT sum(b) FROM t1) + 4.0::DOUBLE) AS pb FROM t1),
p2 AS (SELECT x.g, (x.a + 4.0::DOUBLE * pa) / (sum(x.a) OVER w + 4.0::DOUBLE) AS pa, (x.b + 4.0::DOUBLE * pb) / (sum(x.b) OVER w + 4.0::DOUBLE) AS pb
       FROM t2 x JOIN p1 ON p1.g = substr(x.g, 2) WINDOW w AS (PARTITION BY substr(x.g, 1, 1))),
p3 AS (SELECT x.g, (x.a + 4.0::DOUBLE * pa) / (sum(x.a) OVER w + 4.0::DOUBLE) AS pa, (x.b + 4.0::DOUBLE * pb) / (sum(x.b) OVER w + 4.0::DOUBLE) AS pb
       FROM t3 x JOIN p2 ON p2.g = substr(x.g, 2) WINDOW w AS (PARTITION BY substr(x.g, 1, 2))),
p4 AS (SELECT x.g, (x.a + 4.0::DOUBLE * pa) / (sum(x.a) OVER w + 4.0::DOUBLE) AS pa, (x.b + 4.0::DOUBLE * pb) / (sum(x.b) OVER w + 4.0::DOUBLE) AS pb
       FROM t4 x JOIN p3 ON p3.g = substr(x.g, 2) WINDOW w AS (PARTITION BY substr(x.g, 1, 3))),
s AS (SELECT text, word, sum(round((ln(pa) - ln(pb)) * 1000000)::BIGINT)::DOUBLE / count(*) / 1000000 AS score
      FROM g JOIN p4 ON p4.g = g.g4 GROUP BY text, word),
cells AS (SELECT least(greatest(floor((score + 20) * 100)::INT, 0), 3999) AS cell, count(*) FILTER (word = 'allow') AS a,
            count(*) FILTER (word = 'block') AS b FROM s WHERE word IS NOT NULL GROUP BY 1),
cum AS (SELECT cell, lag(cell) OVER (ORDER BY cell) AS last, sum(a) OVER () AS ta, sum(b) OVER () AS tb, coalesce(sum(a) OVER q, 0) AS ba, coalesce(sum(b) OVER q, 0) AS bb FROM cells
        WINDOW q AS (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lim AS (SELECT (cell + coalesce(last + 1, cell)) / 2.0::DOUBLE / 100 - 20 AS edge FROM cum ORDER BY (ta - ba)::DOUBLE / ta + bb::DOUBLE / tb DESC, cell LIMIT 1)
SELECT page_id, host, path, rule, coalesce(m.word, CASE WHEN s.score >= (SELECT edge FROM lim) THEN 'allow' ELSE 'block' END) AS verdict
FROM m JOIN s USING (text)"""


@_query("op5_url_filter", _OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(spark, _read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@_query("op4_quotation_linking")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_messages(spark, _read(spark, sf_dir, "conversations"))


def _op11_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after another: assignment by full distances, then the exact mean rounded down."""
    start = f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1)::INT AS c, v
      FROM e ORDER BY sha256('2:' || vec_id), v LIMIT {k})"""
    parts = [start]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
      SELECT e.r, q.c, list_sum(list_transform(list_zip(e.v, q.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM e CROSS JOIN c{i} q) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.v, o.v) AS v FROM c{i} o LEFT JOIN (
      SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM (
        SELECT a.c, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM e JOIN a{i} a USING (r), range(1, 65) t(j) GROUP BY a.c, j) GROUP BY c) n USING (c))""")
    return ",".join(parts) + f"""
SELECT e.vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(q.v, ',')) AS centroid_sha256
FROM e JOIN a{rounds} a USING (r) JOIN c{rounds} q ON q.c = a.c"""


@_query("op11_centroid_clusters", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(spark, _read(spark, sf_dir, "embeddings")).drop("centroid")


@_query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    described, _ = periodic_runs(spark, _read(spark, sf_dir, "documents").select("doc_id", "text"), 24, planted)
    return described.drop("key")


@_query("op13_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(spark, _read(spark, sf_dir, "documents").select("doc_id", "text"))
