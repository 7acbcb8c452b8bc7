"""Registered market queries: aggregations, joins, windows, top-k, alerts and feeds over J (jobs_fx) and K."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import scalars as S
from postlens.functions.predicates import with_salary
from postlens.operators import alerts as A
from postlens.operators import market as M
from postlens.plans.fixtures import JK_SQL, REGIONS, jobs_fx, skills_fx
from postlens.plans.registry import query
from postlens.sources.tables import anti, semi, table

LEVELS = S.LEVELS
MEMBERS = ["Brand#1", "Brand#2", "Brand#3"]
STOP = ["the", "and", "of", "en", "le", "la", "de"]
MID = "(salary_min + salary_max) / 2"
BOTH = "salary_min IS NOT NULL AND salary_max IS NOT NULL"
FULL = "source <> 'src0'"
REGION_SQL = """
  SELECT job_id, 'R1' AS region FROM jobs_fx WHERE contains(lower(location), 'nation_1')
  UNION ALL SELECT job_id, 'R2' FROM jobs_fx WHERE contains(lower(location), 'nation_2')
  UNION ALL SELECT job_id, 'R10' FROM jobs_fx WHERE contains(lower(location), 'nation_10')"""


def full_text(spark, sf):
    return jobs_fx(spark, sf).where(F.col("source") != "src0")


@query("totals", JK_SQL + f"SELECT count(*) AS n, count(*) FILTER (WHERE {BOTH}) AS with_salary FROM jobs_fx")
def q_totals(spark, sf):
    j = jobs_fx(spark, sf)
    return j.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()).alias("with_salary"))


@query("value_counts", JK_SQL + "SELECT skill, count(*) AS n FROM skills_fx GROUP BY skill")
def q_value_counts(spark, sf):
    return M.value_counts(skills_fx(spark, sf), "skill")


@query("group_counts", JK_SQL + "SELECT coalesce(seniority, 'unknown') AS seniority, count(*) AS n FROM jobs_fx GROUP BY 1")
def q_group_counts(spark, sf):
    return M.group_counts(jobs_fx(spark, sf), "seniority")


@query("distinct_jobs", JK_SQL + "SELECT count(DISTINCT job_id) AS n FROM skills_fx")
def q_distinct_jobs(spark, sf):
    return M.distinct_count(skills_fx(spark, sf), "job_id")


@query("median_mid", JK_SQL + f"SELECT round_even(median({MID}), 2) AS median_mid FROM jobs_fx WHERE {BOTH}")
def q_median_mid(spark, sf):
    return M.median_mid(jobs_fx(spark, sf))


@query("skill_salary", JK_SQL + f"""
SELECT skill, round_even(median(mid), 2) AS median_mid, count(*) AS n
FROM skills_fx JOIN (SELECT job_id, {MID} AS mid FROM jobs_fx WHERE {BOTH}) USING (job_id)
GROUP BY skill HAVING count(*) >= 15 ORDER BY median_mid DESC, skill LIMIT 15""")
def q_skill_salary(spark, sf):
    return M.term_salary(skills_fx(spark, sf), jobs_fx(spark, sf), min_n=15, k=15)


@query("skill_salary_join", JK_SQL + f"""
SELECT job_id, skill, {MID} AS mid FROM skills_fx JOIN jobs_fx USING (job_id) WHERE {BOTH}""")
def q_skill_salary_join(spark, sf):
    j = with_salary(jobs_fx(spark, sf))
    return M.with_terms(j, skills_fx(spark, sf)).select("job_id", "skill", S.midpoint().alias("mid"))


@query("demand_share", JK_SQL + f"""
SELECT skill, n, round_even(n * 100.0 / (SELECT count(*) FROM jobs_fx WHERE {FULL}), 1) AS share FROM (
  SELECT skill, count(DISTINCT job_id) AS n FROM skills_fx
  WHERE job_id IN (SELECT job_id FROM jobs_fx WHERE {FULL}) GROUP BY skill)
ORDER BY n DESC, skill LIMIT 15""")
def q_demand_share(spark, sf):
    return M.demand_share(skills_fx(spark, sf), full_text(spark, sf), k=15)


@query("set_share", JK_SQL + f"""
SELECT n, round_even(n * 100.0 / (SELECT count(*) FROM jobs_fx WHERE {FULL}), 1) AS share FROM (
  SELECT count(DISTINCT job_id) AS n FROM skills_fx
  WHERE skill IN ('Brand#1', 'Brand#2', 'Brand#3') AND job_id IN (SELECT job_id FROM jobs_fx WHERE {FULL}))""")
def q_set_share(spark, sf):
    return M.set_share(skills_fx(spark, sf), full_text(spark, sf), MEMBERS)


@query("region_multi", JK_SQL + REGION_SQL)
def q_region_multi(spark, sf):
    return M.region_multi(jobs_fx(spark, sf), "location", REGIONS).select("job_id", "region")


@query("region_last", JK_SQL + """
SELECT job_id, CASE WHEN contains(lower(location), 'nation_10') THEN 'R10'
                    WHEN contains(lower(location), 'nation_2') THEN 'R2'
                    WHEN contains(lower(location), 'nation_1') THEN 'R1' ELSE 'Other' END AS region FROM jobs_fx""")
def q_region_last(spark, sf):
    return jobs_fx(spark, sf).select("job_id", M.region_last("location", REGIONS).alias("region"))


@query("region_profile", JK_SQL + f"""
, r AS ({REGION_SQL})
SELECT region, count(salary_min) AS n, round_even(median(CASE WHEN {BOTH} THEN {MID} END), 2) AS median_mid
FROM r JOIN jobs_fx USING (job_id) GROUP BY region
HAVING median(CASE WHEN {BOTH} THEN {MID} END) IS NOT NULL AND median(CASE WHEN {BOTH} THEN {MID} END) <> 0""")
def q_region_profile(spark, sf):
    return M.region_profile(jobs_fx(spark, sf), "location", REGIONS)


_CT_COLS = ", ".join(f"count(*) FILTER (WHERE seniority = '{lv}') AS \"{lv}\"" for lv in LEVELS)


@query("crosstab", JK_SQL + f"""
SELECT company, {_CT_COLS} FROM jobs_fx WHERE company IS NOT NULL AND seniority IS NOT NULL GROUP BY company""")
def q_crosstab(spark, sf):
    return M.crosstab(jobs_fx(spark, sf), "company", "seniority", LEVELS)


_PCT_COLS = ", ".join(
    f"round_even(count(*) FILTER (WHERE seniority = '{lv}') * 100.0 / count(*) FILTER (WHERE seniority IN "
    f"('entry', 'mid', 'senior', 'staff+')), 1) AS \"{lv}\"" for lv in LEVELS)


@query("crosstab_pct", JK_SQL + f"""
, src AS (SELECT * FROM jobs_fx WHERE company IS NOT NULL AND seniority IS NOT NULL),
top AS (SELECT company, count(*) AS row_n FROM src GROUP BY company ORDER BY row_n DESC, company LIMIT 12)
SELECT company, row_n, {_PCT_COLS} FROM src JOIN top USING (company) GROUP BY company, row_n""")
def q_crosstab_pct(spark, sf):
    return M.crosstab_pct(jobs_fx(spark, sf), "company", "seniority", LEVELS, top=12)


@query("multi_hot", JK_SQL + """
SELECT job_id, max(CASE WHEN skill = 'Brand#1' THEN 1 ELSE 0 END) AS "Brand#1",
       max(CASE WHEN skill = 'Brand#2' THEN 1 ELSE 0 END) AS "Brand#2",
       max(CASE WHEN skill = 'Brand#3' THEN 1 ELSE 0 END) AS "Brand#3"
FROM skills_fx WHERE skill IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY job_id""")
def q_multi_hot(spark, sf):
    return M.multi_hot(skills_fx(spark, sf), "job_id", "skill", MEMBERS)


@query("skill_lists", JK_SQL + """
SELECT job_id, string_agg(skill, '|' ORDER BY skill) AS terms, count(*) AS n FROM skills_fx GROUP BY job_id""")
def q_skill_lists(spark, sf):
    t = M.term_lists(skills_fx(spark, sf))
    return t.select("job_id", F.array_join("terms", "|").alias("terms"), F.size("terms").cast("long").alias("n"))


@query("word_freq", """
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
WHERE length(word) >= 2 AND word NOT IN ('the', 'and', 'of', 'en', 'le', 'la', 'de') GROUP BY word""")
def q_word_freq(spark, sf):
    return M.word_freq(table(spark, sf, "documents"), "text", STOP)


@query("daily_growth", """
SELECT day, n, CAST(sum(n) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)""")
def q_daily_growth(spark, sf):
    return M.daily_growth(table(spark, sf, "events"), "ts")


@query("topk_per_group", JK_SQL + """
SELECT source, skill, cnt, rk FROM (
  SELECT source, skill, cnt, row_number() OVER (PARTITION BY source ORDER BY cnt DESC, skill) AS rk FROM (
    SELECT source, skill, count(*) AS cnt FROM skills_fx JOIN jobs_fx USING (job_id) GROUP BY source, skill))
WHERE rk <= 3""")
def q_topk_per_group(spark, sf):
    per = (skills_fx(spark, sf).join(jobs_fx(spark, sf).select("job_id", "source"), "job_id")
           .groupBy("source", "skill").agg(F.count(F.lit(1)).alias("cnt")))
    return M.topk_per_group(per, ["source"], [F.col("cnt").desc(), F.col("skill")], 3)


@query("topk", JK_SQL + "SELECT skill, count(*) AS n FROM skills_fx GROUP BY skill ORDER BY n DESC, skill LIMIT 10")
def q_topk(spark, sf):
    return M.topk(M.value_counts(skills_fx(spark, sf), "skill"), [F.col("n").desc(), F.col("skill")], 10)


@query("latest_n", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 8")
def q_latest_n(spark, sf):
    return M.latest_n(table(spark, sf, "events"), "ts", "event_id", 8).select("event_id", "ts", "event_type")


@query("head_tail", JK_SQL + """
, vc AS (SELECT skill, count(*) AS n FROM skills_fx GROUP BY skill),
h AS (SELECT skill, n, 'head' AS part FROM vc ORDER BY n DESC, skill LIMIT 10),
t AS (SELECT skill, n, 'tail' AS part FROM vc ORDER BY n ASC, skill DESC LIMIT 4)
SELECT skill, n, min(part) AS part FROM (SELECT * FROM h UNION ALL SELECT * FROM t) GROUP BY skill, n""")
def q_head_tail(spark, sf):
    return M.head_tail(M.value_counts(skills_fx(spark, sf), "skill"), "n", "skill", 10, 4)


@query("dense_mix", JK_SQL + """
SELECT d.seniority, d.ord, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES ('entry', 0), ('mid', 1), ('senior', 2), ('staff+', 3)) d(seniority, ord)
LEFT JOIN (SELECT seniority, count(*) AS n FROM jobs_fx WHERE seniority IS NOT NULL GROUP BY 1) c USING (seniority)""")
def q_dense_mix(spark, sf):
    return M.densify(M.value_counts(jobs_fx(spark, sf), "seniority"), "seniority", LEVELS)


@query("region_ranking", JK_SQL + f"""
, r AS ({REGION_SQL})
SELECT region, n, row_number() OVER (ORDER BY n DESC, region) AS rank FROM (
  SELECT region, count(salary_min) AS n FROM r JOIN jobs_fx USING (job_id) GROUP BY region
  HAVING median(CASE WHEN {BOTH} THEN {MID} END) IS NOT NULL AND median(CASE WHEN {BOTH} THEN {MID} END) <> 0)""")
def q_region_ranking(spark, sf):
    return M.ranked_regions(M.region_profile(jobs_fx(spark, sf), "location", REGIONS)).select("region", "n", "rank")


@query("mix_order", JK_SQL + """
SELECT d.seniority, d.ord + 1 AS rank, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES ('staff+', 3), ('entry', 0), ('mid', 1), ('senior', 2)) d(seniority, ord)
LEFT JOIN (SELECT seniority, count(*) AS n FROM jobs_fx WHERE seniority IS NOT NULL GROUP BY 1) c USING (seniority)""")
def q_mix_order(spark, sf):
    dense = M.densify(M.value_counts(jobs_fx(spark, sf), "seniority"), "seniority", LEVELS)
    return M.ordered_mix(dense).select("seniority", F.col("rank").cast("int").alias("rank"), "n")


@query("semi_join", JK_SQL + f"SELECT job_id, skill FROM skills_fx WHERE job_id IN (SELECT job_id FROM jobs_fx WHERE {FULL})")
def q_semi_join(spark, sf):
    return semi(skills_fx(spark, sf), full_text(spark, sf).select("job_id"), "job_id")


@query("anti_join", """
SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def q_anti_join(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return anti(table(spark, sf, "orders").select("o_orderkey"), li, "o_orderkey")


_SEG_SQL = JK_SQL + f"""
, seg AS (
  SELECT job_id, 'Seniority' AS dim, upper(seniority[1]) || seniority[2:] AS segment FROM jobs_fx
    WHERE seniority IN ('entry', 'mid', 'senior', 'staff+')
  UNION ALL SELECT job_id, 'Metro area', region FROM ({REGION_SQL})
  UNION ALL SELECT job_id, 'Source', upper(source[1]) || source[2:] FROM jobs_fx
  UNION ALL SELECT job_id, 'Remote vs onsite',
    CASE WHEN remote IS NOT DISTINCT FROM true THEN 'Remote' ELSE 'Onsite / unspecified' END FROM jobs_fx),
stats AS (SELECT dim, segment, count(*) AS n, round_even(median({MID}), 2) AS median_mid
          FROM seg JOIN jobs_fx USING (job_id) GROUP BY dim, segment HAVING count(*) >= 5),
st AS (SELECT seg.dim, seg.segment, seg.job_id, k.skill FROM seg JOIN skills_fx k USING (job_id)),
per AS (SELECT dim, segment, skill, count(*) AS cnt FROM st GROUP BY dim, segment, skill),
wa AS (SELECT dim, segment, count(DISTINCT job_id) AS n_with FROM st GROUP BY dim, segment),
top AS (SELECT * FROM (SELECT dim, segment, skill, cnt,
          row_number() OVER (PARTITION BY dim, segment ORDER BY cnt DESC, skill) AS rk FROM per) WHERE rk <= 6),
tp AS (SELECT top.dim, top.segment, rk, skill, round_even(cnt * 100.0 / n_with, 1) AS pct
       FROM top JOIN wa USING (dim, segment))
SELECT stats.dim, stats.segment, n, median_mid, rk, skill, pct FROM stats LEFT JOIN tp USING (dim, segment)"""


@query("segment_profile", _SEG_SQL)
def q_segment_profile(spark, sf):
    return M.segment_profile(jobs_fx(spark, sf), skills_fx(spark, sf), REGIONS, LEVELS)


@query("headline", JK_SQL + f"""
SELECT (SELECT count(*) FROM jobs_fx) AS postings,
       (SELECT count(*) FROM jobs_fx WHERE {BOTH}) AS with_salary,
       (SELECT round_even(count(DISTINCT job_id) * 100.0 / (SELECT count(*) FROM jobs_fx WHERE {FULL}), 1)
        FROM skills_fx WHERE skill IN ('Brand#1', 'Brand#2', 'Brand#3')
          AND job_id IN (SELECT job_id FROM jobs_fx WHERE {FULL})) AS member_share,
       (SELECT round_even(median({MID}), 2) FROM jobs_fx WHERE {BOTH}) AS median_mid""")
def q_headline(spark, sf):
    return A.headline(jobs_fx(spark, sf), skills_fx(spark, sf), full_text(spark, sf), MEMBERS)


AS_OF, HOURS = "2001-08-01 00:00:00", 24 * 90
_MATCH_SQL = f"""
, m AS (SELECT * FROM jobs_fx WHERE ingested_at >= TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR
        AND seniority IN ('entry', 'mid'))"""


@query("alert_matches", JK_SQL + _MATCH_SQL + "SELECT job_id, ingested_at, seniority FROM m")
def q_alert_matches(spark, sf):
    return A.find_matches(jobs_fx(spark, sf), AS_OF, HOURS, ["entry", "mid"]).select("job_id", "ingested_at",
                                                                                      "seniority")


@query("alert_order", JK_SQL + _MATCH_SQL + """
SELECT job_id, ingested_at, row_number() OVER (ORDER BY ingested_at DESC, job_id) AS rank FROM m""")
def q_alert_order(spark, sf):
    found = A.find_matches(jobs_fx(spark, sf), AS_OF, HOURS, ["entry", "mid"]).select("job_id", "ingested_at")
    return A.newest_first(found)


_FEED_WHERE = f"""contains(lower(concat_ws(' ', coalesce(title, ''), coalesce(company, ''), coalesce(location, ''))),
  'nation_1') AND seniority IN ('senior', 'staff+') AND {BOTH}"""


@query("feed_page", JK_SQL + f"""
SELECT job_id, title, company, location, seniority,
       '$' || printf('%.0f', round_even(salary_min / 1000, 0)) || 'k – $'
           || printf('%.0f', round_even(salary_max / 1000, 0)) || 'k' AS salary,
       strftime(ingested_at, '%b %d') AS added
FROM jobs_fx WHERE {_FEED_WHERE} ORDER BY ingested_at DESC, job_id LIMIT 200""")
def q_feed_page(spark, sf):
    return A.feed_page(jobs_fx(spark, sf), " Nation_1", ["senior", "staff+"], salary_only=True, n=200)


@query("feed_total", JK_SQL + f"SELECT count(*) AS matched FROM jobs_fx WHERE {_FEED_WHERE}")
def q_feed_total(spark, sf):
    return A.feed_total(jobs_fx(spark, sf), " Nation_1", ["senior", "staff+"], salary_only=True)


@query("digest", JK_SQL + _MATCH_SQL + """
, top AS (SELECT * FROM m ORDER BY ingested_at DESC, job_id LIMIT 8),
lines AS (SELECT string_agg('• ' || title || ' — ' || coalesce(nullif(company, ''), '?') || ' ('
            || coalesce(nullif(location, ''), CASE WHEN remote IS NOT DISTINCT FROM true THEN 'remote' ELSE '' END)
            || ')' || coalesce(CASE WHEN salary_min <> 0 AND salary_max <> 0 THEN ' · $'
                 || printf('%.0f', round_even((salary_min + salary_max) / 2000, 0)) || 'k' END, ''),
            chr(10) ORDER BY ingested_at DESC, job_id) AS body FROM top),
cnt AS (SELECT count(*) AS c FROM m)
SELECT CAST(c AS VARCHAR) || ' new opening' || CASE WHEN c > 1 THEN 's' ELSE '' END AS header, c AS matched,
       body || CASE WHEN c > 8 THEN chr(10) || '…and ' || CAST(c - 8 AS VARCHAR) || ' more' ELSE '' END AS message
FROM lines, cnt WHERE c > 0""")
def q_digest(spark, sf):
    return A.digest(A.find_matches(jobs_fx(spark, sf), AS_OF, HOURS, ["entry", "mid"]), 8)
