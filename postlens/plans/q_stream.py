"""Registered streaming queries (R1-R5): drain with availableNow, then read the sink; oracles = batch semantics."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from postlens.operators.tagging import tag_terms
from postlens.plans.catalog_sql import TAG_SQL
from postlens.plans.fixtures import DOC_VOCAB, JK_SQL, jobs_fx
from postlens.plans.registry import query
from postlens.session import checkpoint_dir, folder_bytes, scratch_path
from postlens.sources import feeds as FD
from postlens.sources.tables import table
from postlens.streaming import jobs as R


def _stream(spark, sf, name, max_files=None):
    schema = table(spark, sf, name).schema
    return R.file_stream(spark, f"{sf.rstrip('/')}/{name}.parquet", schema, max_files)


def _paths(spark, name):
    checkpoint_dir(spark)
    run = uuid.uuid4().hex
    return scratch_path(spark, f"{name}-{run}/out"), scratch_path(spark, f"{name}-{run}/checkpoint")


@query("stream_ingest", """
SELECT key, source, text FROM (
  SELECT CAST(user_id AS VARCHAR) || '-' || event_type AS key, event_type AS source, props AS text,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def q_stream_ingest(spark, sf):
    out, ck = _paths(spark, "stream_ingest")
    s = _stream(spark, sf, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("key"),
        F.col("event_type").alias("source"), F.col("props").alias("text"), "ts", "event_id")
    R.stream_ingest(s, out, "key", ["ts", "event_id"], "text", ck, buckets=16)
    return spark.read.parquet(out).select("key", "source", "text")


@query("stream_dedup", "SELECT event_id, event_type FROM events")
def q_stream_dedup(spark, sf):
    out, ck = _paths(spark, "stream_dedup")
    R.stream_dedup(_stream(spark, sf, "events"), "ts", ["event_id"], "1 hour", out, ck)
    return spark.read.parquet(out).select("event_id", "event_type")


@query("stream_tag", TAG_SQL + "SELECT doc_id, array_to_string(terms, '|') AS terms FROM tags")
def q_stream_tag(spark, sf):
    out, ck = _paths(spark, "stream_tag")
    R.stream_project(_stream(spark, sf, "documents"),
                     lambda d: tag_terms(d.select("doc_id", "text"), ["text"], DOC_VOCAB).select("doc_id", "terms"),
                     out, ck)
    return spark.read.parquet(out).select("doc_id", F.array_join("terms", "|").alias("terms"))


@query("stream_alert", JK_SQL + """
, m AS (SELECT * FROM jobs_fx WHERE seniority IN ('entry', 'mid')),
top AS (SELECT * FROM m ORDER BY ingested_at DESC, job_id LIMIT 8),
lines AS (SELECT string_agg('• ' || title || ' — ' || coalesce(nullif(company, ''), '?') || ' ('
            || coalesce(nullif(location, ''), CASE WHEN remote IS NOT DISTINCT FROM true THEN 'remote' ELSE '' END)
            || ')' || coalesce(CASE WHEN salary_min <> 0 AND salary_max <> 0 THEN ' · $'
                 || printf('%.0f', round_even((salary_min + salary_max) / 2000, 0)) || 'k' END, ''),
            chr(10) ORDER BY ingested_at DESC, job_id) AS body FROM top),
cnt AS (SELECT count(*) AS c FROM m)
SELECT CAST(c AS VARCHAR) || ' new opening' || CASE WHEN c > 1 THEN 's' ELSE '' END AS header, c AS matched,
       body || CASE WHEN c > 8 THEN chr(10) || '…and ' || CAST(c - 8 AS VARCHAR) || ' more' ELSE '' END AS message
FROM lines, cnt WHERE c > 0""")
def q_stream_alert(spark, sf):
    out, ck = _paths(spark, "stream_alert")
    orders = _stream(spark, sf, "orders")
    postings = jobs_fx(spark, sf, orders)
    R.stream_alert(postings, lambda d: d.where(F.col("seniority").isin("entry", "mid")), out, ck)
    return spark.read.parquet(out).select("header", "matched", "message")


@query("stream_daily", """
SELECT day, n, CAST(sum(n) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)""")
def q_stream_daily(spark, sf):
    out, ck = _paths(spark, "stream_daily")
    R.stream_daily(_stream(spark, sf, "events"), "ts", out, ck)
    return R.growth_from_daily(spark.read.parquet(out))


#: Bytes of the source table that one landed file is made of, and the files of a delivery, which are so many times more for larger tables.
FILE_BYTES, FILES = 32 << 20, 3


def _land(pages, folder: str, delivery: int, parts: int = 1) -> None:
    """One delivery of payloads: JSON lines in several files below the feed's landing folder."""
    pages.repartition(FILES * parts).write.text(f"{folder}/delivery-{delivery}")


def _parts(spark, sf, *names, file_bytes: int = FILE_BYTES) -> int:
    """How many files stand for one of a small delivery, so that no task writes or reads a file that grows with its table."""
    return max(1, math.ceil(max(folder_bytes(spark, f"{sf.rstrip('/')}/{n}.parquet") for n in names) / (FILES * file_bytes)))


def _event_pages(events, suffix: str, empty_every: int | None):
    """Feed A payloads of up to 50 items."""
    text = F.col("props") if empty_every is None else F.when(F.col("event_id") % empty_every == 0, F.lit("")).otherwise(F.col("props"))
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.concat("event_type", F.lit(suffix)).alias("title"),
                    F.struct(F.col("user_id").cast("string").alias("display_name")).alias("company"),
                    F.col("value").alias("salary_min"), text.alias("description"), F.col("ts").cast("string").alias("created"))
    pages = events.groupBy(F.floor(F.col("event_id") / 50).alias("p")).agg(F.collect_list(item).alias("results"))
    return pages.select(F.to_json(F.struct("results")))


def _document_pages(docs, suffix: str):
    """Feed C payloads, one item each; the texts' tags and outer white space go on the way."""
    item = F.struct(F.col("doc_id").cast("string").alias("id"), F.concat("lang", F.lit(suffix)).alias("jobTitle"),
                    F.col("source").alias("companyName"), F.col("lang").alias("jobGeo"), F.col("n_chars").cast("double").alias("annualSalaryMin"),
                    F.concat(F.lit(" <p>"), "text", F.lit("</p> ")).alias("jobDescription"), F.lit("2024-02-03T08:00:00Z").alias("pubDate"))
    return docs.select(F.to_json(F.struct(F.array(item).alias("jobs"))))


@query("stream_feeds", """
WITH a AS (SELECT event_id, user_id, value, props, CAST(ts AS DATE) AS day, event_type,
                  event_id % 3 <> 0 AND event_id % 5 <> 0 AS early FROM events),
c AS (SELECT *, doc_id % 4 = 1 AS early FROM documents WHERE lang IN ('en', 'es'))
SELECT 'feed_a' AS source, 'feed_a:' || event_id AS source_id, event_type || CASE WHEN early THEN '-1' ELSE '-2' END AS title,
       CAST(user_id AS VARCHAR) AS company, CAST(NULL AS VARCHAR) AS location, CAST(NULL AS BOOLEAN) AS remote, value AS salary_min,
       props AS description, day AS posted_at FROM a
UNION ALL
SELECT 'feed_c', 'feed_c:' || doc_id, lang || CASE WHEN early THEN '-1' ELSE '-2' END, source, lang, true, CAST(n_chars AS DOUBLE),
       regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), DATE '2024-02-03' FROM c
WHERE regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') <> ''""")
def q_stream_feeds(spark, sf):
    """Deliveries that repeat keys: the first lacks some and has empty descriptions, the second has all, the third, which comes in
    a later run, none that is new. A micro-batch takes two of a feed's three files in a delivery, or that share of them where
    larger tables land in more files."""
    out, ck = _paths(spark, "stream_feeds")
    base = out.rsplit("/", 1)[0]
    events, docs = table(spark, sf, "events"), table(spark, sf, "documents")
    a, c = f"{base}/landed-a", f"{base}/landed-c"
    landings = [(a, FD.feed_a()), (c, FD.feed_c(relevant=["-"], region=dict(words=["en", "es"], codes=[], marker=None))),
                (f"{base}/landed-d", FD.feed_d())]
    parts = _parts(spark, sf, "events", "documents")
    _land(_event_pages(events.where("event_id % 3 <> 0"), "-1", 5), a, 1, parts)
    _land(_document_pages(docs.where("doc_id % 4 = 1"), "-1"), c, 1, parts)
    _land(_event_pages(events, "-2", None), a, 2, parts)
    _land(_document_pages(docs, "-2"), c, 2, parts)
    R.stream_feeds(spark, landings, out, ck, max_files=2 * parts, buckets=8)
    _land(_event_pages(events, "-3", None), a, 3, parts)
    stored = R.stream_feeds(spark, landings, out, ck, max_files=2 * parts, buckets=8)
    return stored.select("source", "source_id", "title", "company", "location", "remote", "salary_min", "description", "posted_at")
