"""Registered ML queries (M1-M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.operators import ml as ML
from postlens.operators.tagging import tokenize
from postlens.plans.fixtures import JK_SQL, REGIONS, jobs_fx, skills_fx
from postlens.plans.registry import query
from postlens.sources.tables import table

_SAL = """
, sal AS (SELECT *, (salary_min + salary_max) / 2 AS salary FROM jobs_fx
          WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL
            AND (salary_min + salary_max) / 2 BETWEEN 30000 AND 500000)"""


@query("features", JK_SQL + _SAL + """
, kept AS (SELECT skill FROM skills_fx WHERE job_id IN (SELECT job_id FROM sal) GROUP BY skill HAVING count(*) >= 10),
base AS (SELECT job_id, salary, seniority, remote,
                CASE WHEN contains(lower(location), 'nation_10') THEN 'R10' WHEN contains(lower(location), 'nation_2')
                     THEN 'R2' WHEN contains(lower(location), 'nation_1') THEN 'R1' ELSE 'Other' END AS metro FROM sal)
SELECT job_id, salary, 'seniority: ' || seniority AS feature, CAST(1.0 AS DOUBLE) AS value FROM base
  WHERE seniority IN ('entry', 'mid', 'senior', 'staff+')
UNION ALL SELECT job_id, salary, 'metro: ' || metro, CAST(1.0 AS DOUBLE) FROM base
UNION ALL SELECT job_id, salary, 'remote', CAST(1.0 AS DOUBLE) FROM base WHERE remote IS NOT DISTINCT FROM true
UNION ALL SELECT DISTINCT s.job_id, b.salary, 'skill: ' || s.skill, CAST(1.0 AS DOUBLE)
  FROM skills_fx s JOIN base b USING (job_id) WHERE s.skill IN (SELECT skill FROM kept)""")
def q_features(spark, sf):
    return ML.feature_rows(jobs_fx(spark, sf), skills_fx(spark, sf), REGIONS, min_n=10)


_IS_TEST = "('0x' || substr(sha256(job_id || ':42'), 1, 8))::BIGINT % 10000 < 2000"


@query("feature_vectors", JK_SQL + _SAL + """
, kept AS (SELECT skill FROM skills_fx WHERE job_id IN (SELECT job_id FROM sal) GROUP BY skill HAVING count(*) >= 10),
base AS (SELECT job_id, seniority, remote,
                CASE WHEN contains(lower(location), 'nation_10') THEN 'R10' WHEN contains(lower(location), 'nation_2')
                     THEN 'R2' WHEN contains(lower(location), 'nation_1') THEN 'R1' ELSE 'Other' END AS metro FROM sal),
rows AS (SELECT job_id, 'seniority: ' || seniority AS feature FROM base WHERE seniority IN ('entry', 'mid', 'senior', 'staff+')
  UNION ALL SELECT job_id, 'metro: ' || metro FROM base
  UNION ALL SELECT job_id, 'remote' FROM base WHERE remote IS NOT DISTINCT FROM true
  UNION ALL SELECT DISTINCT s.job_id, 'skill: ' || s.skill FROM skills_fx s JOIN base b USING (job_id)
            WHERE s.skill IN (SELECT skill FROM kept)),
idx AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM (SELECT DISTINCT feature FROM rows))
SELECT job_id, CAST(idx AS INTEGER) AS idx, CAST(1.0 AS DOUBLE) AS value FROM rows JOIN idx USING (feature)""")
def q_feature_vectors(spark, sf):
    x, _ = ML.build_features(jobs_fx(spark, sf), skills_fx(spark, sf), REGIONS, min_n=10)
    return ML.vector_entries(x, "job_id")


@query("split_counts", JK_SQL + _SAL + f"""
SELECT {_IS_TEST} AS is_test, count(*) AS n FROM sal GROUP BY 1""")
def q_split_counts(spark, sf):
    s = ML.split(ML.salary_set(jobs_fx(spark, sf)), "job_id", 0.2, 42)
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@query("baseline_mae", JK_SQL + _SAL + """
, tr AS (SELECT median(salary) AS m FROM sal WHERE job_id % 5 <> 0)
SELECT count(*) AS n_test, round_even((SELECT m FROM tr), 2) AS train_median,
       round_even(avg(abs(salary - (SELECT m FROM tr))), 2) AS mae FROM sal WHERE job_id % 5 = 0""")
def q_baseline_mae(spark, sf):
    s = ML.split(ML.salary_set(jobs_fx(spark, sf)), "job_id", 0.2, method="mod")
    b = ML.baseline(s)
    return b.agg(F.count(F.lit(1)).alias("n_test"), F.bround(F.first("prediction"), 2).alias("train_median"),
                 F.bround(F.avg(F.abs(F.col("salary") - F.col("prediction"))), 2).alias("mae"))


@query("regression_metrics", JK_SQL + _SAL + """
, tr AS (SELECT median(salary) AS m FROM sal WHERE job_id % 5 <> 0),
te AS (SELECT salary, (SELECT m FROM tr) AS p FROM sal WHERE job_id % 5 = 0)
SELECT count(*) AS n_test, round_even(avg(abs(salary - p)), 2) AS mae,
       round_even(1 - sum((salary - p) * (salary - p)) / (SELECT sum((salary - a) * (salary - a))
                  FROM te, (SELECT avg(salary) AS a FROM te)), 6) AS r2 FROM te""")
def q_regression_metrics(spark, sf):
    s = ML.split(ML.salary_set(jobs_fx(spark, sf)), "job_id", 0.2, method="mod")
    m = ML.regression_metrics(ML.baseline(s))
    return m.select("n_test", F.bround("mae", 2).alias("mae"), F.bround("r2", 6).alias("r2"))


def _model_frame(spark, sf):
    x, index = ML.build_features(jobs_fx(spark, sf), skills_fx(spark, sf), REGIONS, min_n=10)
    return ML.split(x, "job_id", 0.2, 42), index


@query("ridge_premiums")
def q_ridge_premiums(spark, sf):
    x, index = _model_frame(spark, sf)
    return ML.ridge_premiums(x.where(~F.col("is_test")), index, alpha=10.0)


@query("gbt_metrics")
def q_gbt_metrics(spark, sf):
    x, _ = _model_frame(spark, sf)
    return ML.boosted_trees(x)


@query("tfidf", """
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z+/#.-]+')) AS token FROM documents),
tf AS (SELECT doc_id, token, count(*) AS tf FROM t GROUP BY doc_id, token),
dfq AS (SELECT token, count(*) AS df FROM tf GROUP BY token HAVING count(*) >= 5),
w AS (SELECT doc_id, token, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
      FROM tf JOIN dfq USING (token)),
nrm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, token, round_even(w / norm, 6) AS weight FROM w JOIN nrm USING (doc_id)""")
def q_tfidf(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", tokenize("text").alias("tokens"))
    t = ML.tfidf(d, "doc_id", "tokens", min_df=5)
    return t.select("doc_id", "token", F.bround("weight", 6).alias("weight"))


_STOP_SQL = ", ".join(f"'{w}'" for w in ML.TITLE_STOPWORDS)
_BOTH = "salary_min IS NOT NULL AND salary_max IS NOT NULL"


@query("cluster_profile", JK_SQL + f"""
, mem AS (SELECT *, job_id % 6 AS cluster FROM jobs_fx),
size AS (SELECT cluster, count(*) AS size,
                CAST(round_even(median(CASE WHEN {_BOTH} THEN (salary_min + salary_max) / 2 END), 0) AS BIGINT)
                  AS median_salary FROM mem GROUP BY cluster),
per AS (SELECT cluster, skill, count(*) AS cnt FROM skills_fx JOIN mem USING (job_id) GROUP BY cluster, skill),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY cnt DESC, skill) AS rk FROM per)
        WHERE rk <= 6),
words AS (SELECT cluster, unnest(regexp_extract_all(lower(title), '[a-z]+')) AS w FROM mem),
wc AS (SELECT cluster, w, count(*) AS c FROM words WHERE length(w) > 1 AND w NOT IN ({_STOP_SQL})
       GROUP BY cluster, w),
top2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY c DESC, w) AS wr FROM wc)
         WHERE wr <= 2),
lab AS (SELECT cluster, string_agg(upper(w[1]) || w[2:], ' ' ORDER BY wr) AS base FROM top2 GROUP BY cluster),
tops AS (SELECT cluster, list(skill ORDER BY rk) AS tops FROM top GROUP BY cluster),
l2 AS (SELECT s.cluster, coalesce(base, '') AS base, tops,
              list(coalesce(base, '')) OVER (ORDER BY s.cluster ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS prev
       FROM size s LEFT JOIN lab USING (cluster) LEFT JOIN tops USING (cluster)),
l3 AS (SELECT cluster,
              CASE WHEN coalesce(list_bool_or(list_transform(prev, lambda p: starts_with(p, base))), false)
                   THEN base || ' · ' || coalesce(list_filter(tops, lambda s: NOT contains(lower(base), lower(s)))[1],
                                                  'misc')
                   ELSE base END AS label FROM l2)
SELECT s.cluster, label, size, median_salary, rk, skill, CAST(round_even(cnt * 100.0 / size, 0) AS BIGINT) AS share
FROM size s JOIN l3 USING (cluster) LEFT JOIN top USING (cluster)""")
def q_cluster_profile(spark, sf):
    mem = jobs_fx(spark, sf).withColumn("cluster", F.pmod(F.col("job_id"), F.lit(6)))
    return ML.cluster_profile(mem, skills_fx(spark, sf))


@query("kmeans_profile")
def q_kmeans_profile(spark, sf):
    docs = ML.role_docs(jobs_fx(spark, sf), skills_fx(spark, sf))
    members = ML.cluster_roles(docs, k=6)
    return ML.cluster_profile(members, skills_fx(spark, sf))


@query("cluster_ranking", JK_SQL + """
, mem AS (SELECT job_id % 6 + job_id % 2 AS cluster FROM jobs_fx)
SELECT cluster, size, row_number() OVER (ORDER BY size DESC, cluster) AS rank FROM (SELECT cluster, count(*) AS size FROM mem GROUP BY cluster)""")
def q_cluster_ranking(spark, sf):
    mem = jobs_fx(spark, sf).withColumn("cluster", F.pmod(F.col("job_id"), F.lit(6)) + F.pmod(F.col("job_id"), F.lit(2)))
    return ML.ranked_clusters(ML.cluster_profile(mem, skills_fx(spark, sf))).select("cluster", "size", "rank").distinct()


@query("model_artifact")
def q_model_artifact(spark, sf):
    x, index = _model_frame(spark, sf)
    return ML.model_report(x, index).select(F.to_json(F.struct("*")).alias("artifact"))
