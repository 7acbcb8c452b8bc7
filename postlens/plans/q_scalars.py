"""Registered queries for scalar functions (F*) and filters (P*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import predicates as P
from postlens.functions import scalars as S
from postlens.operators.aliases import normalized_counts
from postlens.plans.fixtures import JK_SQL, jobs_fx, skills_fx
from postlens.plans.registry import query
from postlens.sources.tables import table

# Fixture alias map for `documents` tokens (the job-board aliases never occur there).
DOC_ALIASES = {"the": "The", "en": "En", "und": "Und", "was": "Was"}
BRAND_SHORT = {"Brand#1": "B-one", "Brand#10": "B-ten", "Brand#2": "B-two"}
WB = r"[^\p{L}\p{N}_]"  # non-word class used by the RE2 oracles for a Unicode word boundary


@query("strip_html", """
SELECT page_id,
       regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS text
FROM pages""")
def q_strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.strip_html("html").alias("text"))


@query("parse_date", """
SELECT o_orderkey,
       CAST(o_orderdate AS DATE) AS d_plain, CAST(o_orderdate AS DATE) AS d_offset,
       CAST(o_orderdate AS DATE) AS d_zulu, CAST(o_orderdate AS DATE) AS d_day,
       CAST(NULL AS DATE) AS d_year, CAST(NULL AS DATE) AS d_bad_day, CAST(NULL AS DATE) AS d_word
FROM orders""")
def q_parse_date(spark, sf):
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select(
        "o_orderkey",
        S.iso_date(F.col("o_orderdate").cast("string")).alias("d_plain"),
        S.iso_date(F.concat(day, F.lit("T23:30:00-05:00"))).alias("d_offset"),
        S.iso_date(F.concat(day, F.lit("T10:00:00Z"))).alias("d_zulu"),
        S.iso_date(day).alias("d_day"),
        S.iso_date(F.date_format("o_orderdate", "yyyy")).alias("d_year"),
        S.iso_date(F.concat(F.substring(day, 1, 8), F.lit("32"))).alias("d_bad_day"),
        S.iso_date(F.concat(F.lit("nope-"), day)).alias("d_word"),
    )


@query("in_region", JK_SQL + f"""
SELECT job_id,
       regexp_matches(coalesce(location, ''), '(?i)(nation_1|middle east)')
       OR regexp_matches(coalesce(location, ''), ',\\s*(?:ASIA|AFRICA)\\b')
       OR contains(coalesce(location, ''), 'NATION_22') AS eligible
FROM jobs_fx""")
def q_in_region(spark, sf):
    j = jobs_fx(spark, sf)
    return j.select("job_id", S.in_region("location", ["nation_1", "middle east"], ["ASIA", "AFRICA"],
                                          "NATION_22").alias("eligible"))


@query("is_relevant", f"""
SELECT doc_id, regexp_matches(text, '(?i)(worthless|(^|{WB})en({WB}|$)|copyright)') AS relevant FROM documents""")
def q_is_relevant(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.is_relevant("text", ["worthless", r"(?<![\p{L}\p{N}_])en(?![\p{L}\p{N}_])",
                                                      "copyright"]).alias("relevant"))


@query("normalize_terms", """
WITH t AS (SELECT unnest(regexp_extract_all(text, '\\S+')) AS tok FROM documents),
c AS (SELECT regexp_replace(tok, '[.,;]+$', '') AS cleaned FROM t)
SELECT coalesce(CASE lower(cleaned) WHEN 'the' THEN 'The' WHEN 'en' THEN 'En' WHEN 'und' THEN 'Und'
                WHEN 'was' THEN 'Was' END, cleaned) AS term, count(*) AS n
FROM c GROUP BY 1""")
def q_normalize_terms(spark, sf):
    d = table(spark, sf, "documents")
    toks = S.explode_present(d, F.regexp_extract_all("text", F.lit(r"(\S+)"), 1), "tok")
    aliases = spark.createDataFrame(list(DOC_ALIASES.items()), "alias string, canonical string")
    return normalized_counts(toks, "tok", aliases)


@query("compose_key", "SELECT doc_id, concat(source, ':', CAST(doc_id AS VARCHAR)) AS key FROM documents")
def q_compose_key(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.compose_key("source", "doc_id").alias("key"))


@query("tri_state", JK_SQL + """
SELECT job_id, CASE WHEN contains(location, 'NATION_1') THEN true END AS flag FROM jobs_fx""")
def q_tri_state(spark, sf):
    return jobs_fx(spark, sf).select("job_id", S.true_or_null("location", "NATION_1").alias("flag"))


@query("midpoint", JK_SQL + """
SELECT job_id, (salary_min + salary_max) / 2 AS mid FROM jobs_fx""")
def q_midpoint(spark, sf):
    return jobs_fx(spark, sf).select("job_id", S.midpoint().alias("mid"))


@query("salary_band", JK_SQL + """
SELECT job_id,
       CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL
            THEN '$' || printf('%.0f', round_even(salary_min / 1000, 0)) || 'k – $'
                 || printf('%.0f', round_even(salary_max / 1000, 0)) || 'k' ELSE '' END AS band
FROM jobs_fx""")
def q_salary_band(spark, sf):
    return jobs_fx(spark, sf).select("job_id", S.salary_band().alias("band"))


@query("labels_fmt", JK_SQL + """
SELECT job_id,
       '$' || printf('%.0f', round_even(((salary_min + salary_max) / 2) / 1000, 0)) || 'k' AS money,
       format('{:,}', job_id * 1000) AS count_txt,
       printf('%.0f', round_even(salary_min / salary_max * 100, 0)) || '%' AS pct,
       CASE WHEN round_even((salary_min - salary_max) / 1000, 1) < 0 THEN '-' ELSE '+' END
         || format('{:,.1f}', abs(round_even((salary_min - salary_max) / 1000, 1))) || 'k' AS signed
FROM jobs_fx WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL""")
def q_labels_fmt(spark, sf):
    j = P.with_salary(jobs_fx(spark, sf))
    return j.select(
        "job_id",
        S.money_k(S.midpoint()).alias("money"),
        S.count_label(F.col("job_id") * 1000).alias("count_txt"),
        S.pct_label(F.col("salary_min") / F.col("salary_max") * 100).alias("pct"),
        S.signed_k(F.col("salary_min") - F.col("salary_max")).alias("signed"),
    )


@query("day_label", "SELECT event_id, strftime(ts, '%b %d') AS day FROM events")
def q_day_label(spark, sf):
    return table(spark, sf, "events").select("event_id", S.day_label("ts").alias("day"))


@query("text_window", """
SELECT doc_id,
       source || chr(10) || substring(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '^ | $', '', 'g'), 1, 4200)
         AS window
FROM documents""")
def q_text_window(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.text_window("source", "text", 4200).alias("window"))


@query("truncate", """
SELECT doc_id, substring(text, 1, 6000) AS t6000, substring(text, 1, 70) AS t70, substring(text, 1, 50) AS t50
FROM documents""")
def q_truncate(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.truncate("text", 6000).alias("t6000"), S.truncate("text", 70).alias("t70"),
                    S.truncate("text", 50).alias("t50"))


@query("short_names", JK_SQL + """
SELECT coalesce(CASE skill WHEN 'Brand#1' THEN 'B-one' WHEN 'Brand#10' THEN 'B-ten' WHEN 'Brand#2' THEN 'B-two' END,
                skill) AS short, count(*) AS n
FROM skills_fx GROUP BY 1""")
def q_short_names(spark, sf):
    k = skills_fx(spark, sf)
    return k.groupBy(S.lookup_or_self("skill", BRAND_SHORT).alias("short")).agg(F.count(F.lit(1)).alias("n"))


def _replies(spark, sf):
    e = table(spark, sf, "events")
    reply = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
             .when(F.col("event_id") % 3 == 1, F.concat(F.lit("  "), F.col("props"), F.lit("\n")))
             .otherwise(F.concat(F.lit("{broken "), F.col("props"))))
    return e.select("event_id", reply.alias("reply"))


@query("parse_reply", """
SELECT event_id, event_id % 3 <> 2 AS ok,
       CASE WHEN event_id % 3 <> 2 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events""")
def q_parse_reply(spark, sf):
    r = _replies(spark, sf)
    parsed = S.parse_reply("reply", "k BIGINT")
    return r.select("event_id", S.reply_ok("reply").alias("ok"), parsed["k"].alias("k"))


@query("clean_terms", """
SELECT doc_id, array_to_string(x, '|') AS terms, len(x) AS n_terms FROM (
  SELECT doc_id, list_sort(list_distinct(list_transform(
      list_filter(regexp_extract_all(text, '\\S+'), lambda t: length(t) > 0 AND length(t) < 12),
      lambda t: coalesce(CASE lower(regexp_replace(t, '[.,;]+$', '')) WHEN 'the' THEN 'The' WHEN 'en' THEN 'En'
                         WHEN 'und' THEN 'Und' WHEN 'was' THEN 'Was' END,
                    regexp_replace(t, '[.,;]+$', ''))))) AS x
  FROM documents)""")
def q_clean_terms(spark, sf):
    d = table(spark, sf, "documents")
    arr = S.clean_terms(F.regexp_extract_all("text", F.lit(r"(\S+)"), 1), max_len=12, aliases=DOC_ALIASES)
    return d.select("doc_id", F.array_join(arr, "|").alias("terms"), F.size(arr).cast("long").alias("n_terms"))


@query("validate_domain", JK_SQL + """
SELECT job_id, CASE WHEN v IN ('entry', 'mid', 'senior', 'staff+') THEN v END AS level
FROM (SELECT job_id, coalesce(seniority, lower(split_part(title, ' ', 2))) AS v FROM jobs_fx)""")
def q_validate_domain(spark, sf):
    j = jobs_fx(spark, sf)
    v = F.coalesce(F.col("seniority"), F.lower(F.split_part("title", F.lit(" "), F.lit(2))))
    return j.select("job_id", S.in_domain(v).alias("level"))


@query("title_label", JK_SQL + """
SELECT job_id, array_to_string(list_transform(string_split(lower(title), ' '),
                                              lambda w: upper(w[1]) || w[2:]), ' ') AS label FROM jobs_fx""")
def q_title_label(spark, sf):
    return jobs_fx(spark, sf).select("job_id", S.title_label(F.lower("title")).alias("label"))


@query("drop_null", JK_SQL + "SELECT job_id FROM jobs_fx WHERE company IS NOT NULL AND seniority IS NOT NULL")
def q_drop_null(spark, sf):
    return P.drop_null(jobs_fx(spark, sf), ["company", "seniority"]).select("job_id")


@query("salary_range", JK_SQL + """
SELECT job_id, (salary_min + salary_max) / 2 AS mid FROM jobs_fx
WHERE (salary_min + salary_max) / 2 BETWEEN 100000 AND 300000""")
def q_salary_range(spark, sf):
    j = jobs_fx(spark, sf)
    return j.where(P.between(S.midpoint(), 100000, 300000)).select("job_id", S.midpoint().alias("mid"))


@query("full_text_only", JK_SQL + "SELECT job_id FROM jobs_fx WHERE source <> 'src0'")
def q_full_text_only(spark, sf):
    return jobs_fx(spark, sf).where(P.exclude("source", "src0")).select("job_id")


@query("in_list", JK_SQL + "SELECT job_id FROM jobs_fx WHERE seniority IN ('entry', 'mid')")
def q_in_list(spark, sf):
    return jobs_fx(spark, sf).where(P.any_of("seniority", ["entry", "mid"])).select("job_id")


@query("remote_split", JK_SQL + """
SELECT CASE WHEN remote IS NOT DISTINCT FROM true THEN 'Remote' ELSE 'Onsite / unspecified' END AS segment,
       count(*) AS n FROM jobs_fx GROUP BY 1""")
def q_remote_split(spark, sf):
    j = jobs_fx(spark, sf)
    seg = F.when(P.is_true("remote"), F.lit("Remote")).otherwise(F.lit("Onsite / unspecified"))
    return j.groupBy(seg.alias("segment")).agg(F.count(F.lit(1)).alias("n"))


@query("search", JK_SQL + """
SELECT job_id FROM jobs_fx
WHERE contains(lower(concat_ws(' ', coalesce(title, ''), coalesce(company, ''), coalesce(location, ''))), 'nation_1')""")
def q_search(spark, sf):
    return P.search(jobs_fx(spark, sf), "  NATION_1 ").select("job_id")


@query("lookback", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 72 HOUR""")
def q_lookback(spark, sf):
    e = table(spark, sf, "events")
    return e.where(P.since("ts", "2024-01-30 00:00:00", 72)).select("event_id", "ts")


@query("having_min", JK_SQL + """
SELECT skill, count(*) AS n FROM skills_fx GROUP BY skill HAVING count(*) >= 2300""")
def q_having_min(spark, sf):
    from postlens.operators.market import value_counts
    return P.having_min(value_counts(skills_fx(spark, sf), "skill"), "n", 2300)
