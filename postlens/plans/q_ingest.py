"""Registered ingest queries: feed readers, scans, dedup and sinks (S*, D*, K*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from postlens.functions import scalars as S
from postlens.operators import dedup as D
from postlens.operators.market import topk, value_counts
from postlens.operators.tagging import classify_first
from postlens.plans.fixtures import JK_SQL, jobs_fx, skills_fx
from postlens.plans.registry import query
from postlens.session import checkpoint_dir, scratch_path
from postlens.sources import feeds as FD
from postlens.sources import sinks as K
from postlens.sources.tables import scan_pending, semi, table

BW = r"(?<![\p{L}\p{N}_])"
EW = r"(?![\p{L}\p{N}_])"
WB = r"[^\p{L}\p{N}_]"


def _payload_a(spark, sf):
    e = table(spark, sf, "events")
    item = F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("display_name")).alias("company"),
        F.struct(F.concat(F.lit("zone-"), F.col("event_type")).alias("display_name")).alias("location"),
        F.col("value").alias("salary_min"), (F.col("value") * 2).alias("salary_max"),
        F.col("props").alias("description"),
        F.concat(F.lit("http://e/"), F.col("event_id").cast("string")).alias("redirect_url"),
        F.col("ts").cast("string").alias("created"))
    return e.select(F.col("event_id").alias("page"), F.to_json(F.struct(F.array(item).alias("results"))).alias("payload"))


@query("feed_nested", """
SELECT 'feed_a' AS source, 'feed_a:' || CAST(event_id AS VARCHAR) AS source_id, event_type AS title,
       'user' || CAST(user_id AS VARCHAR) AS company, 'zone-' || event_type AS location, CAST(NULL AS BOOLEAN) AS remote,
       value AS salary_min, value * 2 AS salary_max, props AS description, 'http://e/' || CAST(event_id AS VARCHAR) AS url,
       CAST(ts AS DATE) AS posted_at
FROM events""")
def q_feed_nested(spark, sf):
    p = _payload_a(spark, sf)
    return FD.parse_feed(p, "payload", FD.feed_a(), F.col("page")).select(*FD.POSTING_COLUMNS)


_FEED_A_SQL = """
SELECT 'feed_a' AS source, 'feed_a:' || CAST(event_id AS VARCHAR) AS source_id, event_type AS title,
       'user' || CAST(user_id AS VARCHAR) AS company, 'zone-' || event_type AS location, CAST(NULL AS BOOLEAN) AS remote,
       value AS salary_min, value * 2 AS salary_max, props AS description, 'http://e/' || CAST(event_id AS VARCHAR) AS url,
       CAST(ts AS DATE) AS posted_at
FROM events"""


@query("feed_files", _FEED_A_SQL)
def q_feed_files(spark, sf):
    """S1 over landed files: the payloads are written as JSON-lines files to the shared folder, then read back with
    the declared payload schema (no inference pass)."""
    checkpoint_dir(spark)
    landing = scratch_path(spark, f"landing-a-{uuid.uuid4().hex}")
    _payload_a(spark, sf).select("payload").write.text(landing)
    return FD.read_feed(spark, landing, FD.feed_a()).select(*FD.POSTING_COLUMNS)


_B_REL = [f"{BW}(?:the|de){EW}"]
_B_REGION = dict(words=["example.com"], codes=[], marker=None)


def _feed_b(spark, sf):
    pg = table(spark, sf, "pages")
    item = F.struct(
        F.col("page_id").cast("string").alias("id"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", "//([^/]+)", 1).alias("company_name"),
        F.col("url").alias("candidate_required_location"), F.col("html").alias("description"), F.col("url"),
        F.lit(None).cast("string").alias("publication_date"))
    p = pg.select(F.col("page_id").alias("page"), F.to_json(F.struct(F.array(item).alias("jobs"))).alias("payload"))
    return FD.parse_feed(p, "payload", FD.feed_b(relevant=_B_REL, region=_B_REGION), F.col("page"))


_B_SQL = f"""
SELECT 'feed_b' AS source, 'feed_b:' || CAST(page_id AS VARCHAR) AS source_id, title,
       regexp_extract(url, '//([^/]+)', 1) AS company, url AS location, true AS remote,
       CAST(NULL AS DOUBLE) AS salary_min, CAST(NULL AS DOUBLE) AS salary_max,
       regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS description, url,
       CAST(NULL AS DATE) AS posted_at
FROM (SELECT *, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)
WHERE regexp_matches(title, '(?i)(^|{WB})(the|de)({WB}|$)')
  AND regexp_matches(url, '(?i)(^|{WB})example\\.com({WB}|$)')"""


@query("feed_filtered", _B_SQL)
def q_feed_filtered(spark, sf):
    return _feed_b(spark, sf).select(*FD.POSTING_COLUMNS)


_C_REL = [f"{BW}(?:the|el|la){EW}"]
_C_REGION = dict(words=["en", "es"], codes=[], marker=None)


def _feed_c(spark, sf):
    d = table(spark, sf, "documents")
    item = F.struct(
        F.col("doc_id").cast("string").alias("id"), F.substring_index("text", "\n", 1).alias("jobTitle"),
        F.col("source").alias("companyName"), F.col("lang").alias("jobGeo"),
        F.col("n_chars").cast("double").alias("annualSalaryMin"), (F.col("n_chars") * 1.5).alias("annualSalaryMax"),
        F.col("text").alias("jobDescription"), F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(F.lit("2024-02-"), F.lpad((F.pmod("doc_id", F.lit(28)) + 1).cast("string"), 2, "0"),
                 F.lit("T08:00:00Z")).alias("pubDate"))
    p = d.select(F.col("doc_id").alias("page"), F.to_json(F.struct(F.array(item).alias("jobs"))).alias("payload"))
    return FD.parse_feed(p, "payload", FD.feed_c(relevant=_C_REL, region=_C_REGION), F.col("page"))


_C_SQL = f"""
SELECT 'feed_c' AS source, 'feed_c:' || CAST(doc_id AS VARCHAR) AS source_id, title, source AS company,
       lang AS location, true AS remote, CAST(n_chars AS DOUBLE) AS salary_min, n_chars * 1.5 AS salary_max,
       regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS description,
       'doc://' || CAST(doc_id AS VARCHAR) AS url,
       CAST('2024-02-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS DATE) AS posted_at
FROM (SELECT *, split_part(text, chr(10), 1) AS title FROM documents)
WHERE regexp_matches(title, '(?i)(^|{WB})(the|el|la)({WB}|$)')
  AND regexp_matches(lang, '(?i)(^|{WB})(en|es)({WB}|$)')"""


@query("feed_mapped", _C_SQL)
def q_feed_mapped(spark, sf):
    return _feed_c(spark, sf).select(*FD.POSTING_COLUMNS)


_D_REGION = dict(words=["assistant"], codes=[], marker="Flexible / Remote")


def _feed_d(spark, sf):
    c = table(spark, sf, "conversations")
    second = F.when(F.col("turn") == 0, F.lit("Flexible / Remote")).otherwise(
        F.concat(F.lit("Turn "), F.col("turn").cast("string")))
    item = F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.col("role").alias("name"),
        F.struct(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("name")).alias("company"),
        F.array(F.struct(F.col("role").alias("name")), F.struct(second.alias("name"))).alias("locations"),
        F.col("text").alias("contents"),
        F.struct(F.concat(F.lit("conv://"), F.col("conv_id").cast("string")).alias("landing_page")).alias("refs"),
        F.lit(None).cast("string").alias("publication_date"))
    p = c.select(F.col("conv_id").alias("page"), F.to_json(F.struct(F.array(item).alias("results"))).alias("payload"))
    return FD.parse_feed(p, "payload", FD.feed_d(relevant=["user|assistant"], region=_D_REGION), F.col("page"))


_D_SQL = f"""
SELECT 'feed_d' AS source, 'feed_d:' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS source_id,
       role AS title, 'conv' || CAST(conv_id AS VARCHAR) AS company, loc AS location,
       CASE WHEN contains(loc, 'Flexible / Remote') THEN true END AS remote,
       CAST(NULL AS DOUBLE) AS salary_min, CAST(NULL AS DOUBLE) AS salary_max,
       regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS description,
       'conv://' || CAST(conv_id AS VARCHAR) AS url, CAST(NULL AS DATE) AS posted_at
FROM (SELECT *, role || ', ' || CASE WHEN turn = 0 THEN 'Flexible / Remote' ELSE 'Turn ' || CAST(turn AS VARCHAR) END
             AS loc FROM conversations)
WHERE regexp_matches(role, '(?i)user|assistant')
  AND (regexp_matches(loc, '(?i)(^|{WB})assistant({WB}|$)') OR contains(loc, 'Flexible / Remote'))"""


@query("feed_array_join", _D_SQL)
def q_feed_array_join(spark, sf):
    return _feed_d(spark, sf).select(*FD.POSTING_COLUMNS)


@query("union_feeds", f"""
SELECT source, source_id, 0 AS feed_ord, title FROM ({_C_SQL})
UNION ALL SELECT source, source_id, 1, title FROM ({_B_SQL})
UNION ALL SELECT source, source_id, 2, title FROM ({_D_SQL})""")
def q_union_feeds(spark, sf):
    u = FD.union_feeds([_feed_c(spark, sf), _feed_b(spark, sf), _feed_d(spark, sf)])
    return u.select("source", "source_id", "feed_ord", "title")


@query("scan_not_null", JK_SQL + """
SELECT job_id, salary_min, salary_max FROM jobs_fx WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL""")
def q_scan_not_null(spark, sf):
    from postlens.functions.predicates import with_salary
    return with_salary(jobs_fx(spark, sf)).select("job_id", "salary_min", "salary_max")


@query("scan_pending", JK_SQL + "SELECT job_id FROM jobs_fx WHERE remote IS FALSE ORDER BY job_id LIMIT 100")
def q_scan_pending(spark, sf):
    return scan_pending(jobs_fx(spark, sf), "remote", ["job_id"], 100).select("job_id")


@query("scan_by_keys", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def q_scan_by_keys(spark, sf):
    return semi(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


# ----------------------------------------------------------------------------------------------- dedup and sinks
def _batch(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("key"),
        F.col("l_returnflag").alias("source"),
        F.when(F.col("l_quantity") < 5, F.lit("")).otherwise(
            F.concat("l_returnflag", "l_linestatus", F.lit("-"), F.col("l_partkey").cast("string"))).alias("text"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("feed_ord"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")


ORDER = ["feed_ord", "l_shipdate", "l_partkey", "l_suppkey"]
_BATCH_SQL = """
WITH b AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key, l_returnflag AS source,
         CASE WHEN l_quantity < 5 THEN '' ELSE l_returnflag || l_linestatus || '-' || CAST(l_partkey AS VARCHAR) END AS text,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS feed_ord,
         l_shipdate, l_partkey, l_suppkey, l_linenumber FROM lineitem),
e AS (SELECT key FROM b WHERE l_linenumber = 1),
new AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY feed_ord, l_shipdate, l_partkey, l_suppkey, source, text,
                               l_linenumber) AS rn
  FROM b WHERE length(text) > 0 AND key NOT IN (SELECT key FROM e)) WHERE rn = 1)
"""


def _existing(spark, sf):
    return _batch(spark, sf).where(F.col("l_linenumber") == 1)


@query("dedup_append", _BATCH_SQL + "SELECT key, source, text, feed_ord, l_partkey FROM new")
def q_dedup_append(spark, sf):
    new = D.dedup_append(_existing(spark, sf), _batch(spark, sf), "key", ORDER, "text")
    return new.select("key", "source", "text", "feed_ord", "l_partkey")


@query("dedup_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                                        l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""")
def q_dedup_first(spark, sf):
    li = table(spark, sf, "lineitem")
    return D.first_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("key_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_key_violations(spark, sf):
    return D.key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("append_new", _BATCH_SQL + """
, ex AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY feed_ord, l_shipdate, l_partkey, l_suppkey, source, text,
                               l_linenumber) AS rn FROM b WHERE l_linenumber = 1) WHERE rn = 1)
SELECT key, source, text FROM ex UNION ALL SELECT key, source, text FROM new""")
def q_append_new(spark, sf):
    checkpoint_dir(spark)
    path = scratch_path(spark, f"append_new-{uuid.uuid4().hex}")
    existing = D.first_per_key(_existing(spark, sf), "key", ORDER)
    existing.write.partitionBy("source").parquet(path)
    K.append_new(spark, path, _batch(spark, sf), "key", ORDER, "text")
    return spark.read.parquet(path).select("key", "source", "text")


@query("ingest_report", _BATCH_SQL + """
, per AS (SELECT b.source, CAST(coalesce(n.c, 0) AS BIGINT) AS new_rows,
                 CAST(count(*) - coalesce(n.c, 0) AS BIGINT) AS skipped
          FROM b LEFT JOIN (SELECT source, count(*) AS c FROM new GROUP BY source) n USING (source)
          GROUP BY b.source, n.c)
SELECT source, new_rows, skipped, (SELECT count(*) FROM e) + (SELECT count(*) FROM new) AS table_total FROM per
UNION ALL SELECT 'ALL', CAST(sum(new_rows) AS BIGINT), CAST(sum(skipped) AS BIGINT),
                 (SELECT count(*) FROM e) + (SELECT count(*) FROM new) FROM per""")
def q_ingest_report(spark, sf):
    existing, batch = _existing(spark, sf), _batch(spark, sf)
    flags = D.flag_new(existing, batch, "key", ORDER, "text", "source")
    return K.flagged_report(flags, "source", existing.select(F.count(F.lit(1))).scalar())


_K2_SQL = JK_SQL + """
, target AS (SELECT job_id, skill, 'rules' AS method FROM skills_fx
             UNION ALL SELECT job_id, skill, 'llm' FROM skills_fx WHERE skill IN ('Brand#1', 'Brand#2')),
new AS (SELECT DISTINCT l_orderkey AS job_id, p_type AS skill, 'rules' AS method
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R')
SELECT * FROM target t WHERE NOT (t.method = 'rules' AND t.job_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('R', 'A')))
UNION ALL SELECT * FROM new"""


@query("replace_by_key", _K2_SQL)
def q_replace_by_key(spark, sf):
    k = skills_fx(spark, sf)
    target = k.withColumn("method", F.lit("rules")).unionByName(
        k.where(F.col("skill").isin("Brand#1", "Brand#2")).withColumn("method", F.lit("llm")))
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    p = table(spark, sf, "part")
    new = (li.join(p, li.l_partkey == p.p_partkey)
           .select(F.col("l_orderkey").alias("job_id"), F.col("p_type").alias("skill"), F.lit("rules").alias("method"))
           .distinct())
    # orders with returned or accepted lines were worked on; those without returned ones yield nothing
    done = table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("R", "A")).select(F.col("l_orderkey").alias("job_id"))
    return K.replace_by_key(target, new, "job_id", method="rules", processed=done)


TITLE_RULES = [("URGENT", "staff+"), ("HIGH", "senior"), ("LOW", "entry")]


@query("fill_if_missing", JK_SQL + """
SELECT job_id, coalesce(nullif(seniority, ''), CASE WHEN regexp_matches(title, 'URGENT') THEN 'staff+'
       WHEN regexp_matches(title, 'HIGH') THEN 'senior' WHEN regexp_matches(title, 'LOW') THEN 'entry' ELSE 'mid' END)
       AS seniority FROM jobs_fx""")
def q_fill_if_missing(spark, sf):
    j = jobs_fx(spark, sf)
    return K.fill_if_missing(j, "seniority", classify_first("title", TITLE_RULES, "mid")).select("job_id", "seniority")


@query("update_by_key", JK_SQL + """
SELECT job_id, remote, CASE WHEN remote IS NOT DISTINCT FROM true THEN NULL ELSE salary_min END AS salary_min,
       CASE WHEN remote IS NOT DISTINCT FROM true THEN salary_max * 2 ELSE salary_max END AS salary_max
FROM jobs_fx""")
def q_update_by_key(spark, sf):
    j = jobs_fx(spark, sf)
    upd = j.where(F.col("remote").eqNullSafe(True)).select(
        "job_id", F.lit(None).cast("double").alias("salary_min"), (F.col("salary_max") * 2).alias("salary_max"))
    out = K.update_by_key(j, upd, "job_id", ["salary_min", "salary_max"])
    return out.select("job_id", "remote", "salary_min", "salary_max")


def _artifact(spark, sf):
    top = topk(value_counts(skills_fx(spark, sf), "skill"), [F.col("n").desc(), F.col("skill")], 10)
    arr = F.array_sort(F.collect_list(F.struct("skill", "n")),
                       lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1)
                       .when(a["skill"] < b["skill"], -1).when(a["skill"] > b["skill"], 1).otherwise(0))
    return top.agg(F.struct(F.lit(10).alias("k"), arr.alias("top")).alias("a"))


@query("artifact_json", JK_SQL + """
SELECT CAST(to_json({'k': 10, 'top': list({'skill': skill, 'n': n} ORDER BY n DESC, skill)}) AS VARCHAR) AS artifact
FROM (SELECT skill, count(*) AS n FROM skills_fx GROUP BY skill ORDER BY n DESC, skill LIMIT 10)""")
def q_artifact_json(spark, sf):
    return _artifact(spark, sf).select(F.to_json("a").alias("artifact"))


@query("read_artifact", JK_SQL + """
SELECT 10 AS k, skill, n FROM (SELECT skill, count(*) AS n FROM skills_fx GROUP BY skill ORDER BY n DESC, skill LIMIT 10)""")
def q_read_artifact(spark, sf):
    checkpoint_dir(spark)
    path = scratch_path(spark, f"artifact-{uuid.uuid4().hex}")
    K.write_artifact(_artifact(spark, sf).select("a.*"), path)
    return K.read_artifact(spark, path, "k int, top array<struct<skill:string, n:bigint>>").select(
        "k", F.explode("top").alias("t")).select("k", "t.skill", "t.n")


@query("extract_report", JK_SQL + """
SELECT (SELECT count(*) FROM skills_fx) AS tag_rows, count(*) AS postings,
       round_even((SELECT count(*) FROM skills_fx) / greatest(count(*), 1), 1) AS avg_per_posting FROM jobs_fx""")
def q_extract_report(spark, sf):
    return K.extract_report(skills_fx(spark, sf), jobs_fx(spark, sf))
