"""Postings-shaped views over the driver tables (jobs_fx = J, skills_fx = K) and test dictionaries.

The views inject NULLs, empty strings, tri-state booleans and overlapping region names (the driver tables have none);
every row of the source tables is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.tagging import Term
from postlens.sources.tables import table


def jobs_fx(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """J; ``orders`` may be a stream (stream-static joins with the dimension tables)."""
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(r, n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("o_orderkey").alias("job_id"),
        F.expr("concat('src', cast(o_orderkey % 4 as string))").alias("source"),
        F.expr("concat(c_mktsegment, ' ', substring(o_orderpriority, 3))").alias("title"),
        F.expr("case when o_orderkey % 13 = 0 then '' when o_orderkey % 17 <> 0 then c_name end").alias("company"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")).alias("location"),
        F.expr("case o_orderstatus when 'F' then true when 'P' then false end").alias("remote"),
        F.expr("case when o_orderkey % 7 <> 0 then o_totalprice * 0.9 end").alias("salary_min"),
        F.expr("case when o_orderkey % 11 <> 0 then o_totalprice * 1.1 end").alias("salary_max"),
        F.expr("case o_orderpriority when '5-LOW' then 'entry' when '3-MEDIUM' then 'mid' "
               "when '2-HIGH' then 'senior' when '1-URGENT' then 'staff+' end").alias("seniority"),
        F.col("o_orderdate").alias("ingested_at"),
    )


def skills_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").alias("job_id"), F.col("p_brand").alias("skill"))
            .distinct())


# SQL text of the same views for the DuckDB oracle (prepended as CTEs).
J_SQL = """jobs_fx AS (
  SELECT o.o_orderkey AS job_id,
         concat('src', CAST(o.o_orderkey % 4 AS VARCHAR)) AS source,
         concat(c.c_mktsegment, ' ', substring(o.o_orderpriority, 3)) AS title,
         CASE WHEN o.o_orderkey % 13 = 0 THEN '' WHEN o.o_orderkey % 17 <> 0 THEN c.c_name END AS company,
         concat(n.n_name, ', ', r.r_name) AS location,
         CASE o.o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END AS remote,
         CASE WHEN o.o_orderkey % 7 <> 0 THEN o.o_totalprice * 0.9 END AS salary_min,
         CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_totalprice * 1.1 END AS salary_max,
         CASE o.o_orderpriority WHEN '5-LOW' THEN 'entry' WHEN '3-MEDIUM' THEN 'mid'
              WHEN '2-HIGH' THEN 'senior' WHEN '1-URGENT' THEN 'staff+' END AS seniority,
         o.o_orderdate AS ingested_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey)"""
K_SQL = """skills_fx AS (
  SELECT DISTINCT l.l_orderkey AS job_id, p.p_brand AS skill
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""
JK_SQL = "WITH " + J_SQL + ",\n" + K_SQL + "\n"

# ---------------------------------------------------------------------------------------------------------------
# Test dictionaries (the reference vocabulary matches nothing in `documents`, so tests pass their own).
# ---------------------------------------------------------------------------------------------------------------
DOC_VOCAB = [
    Term("en", "en"),
    Term("license", "Copyright|License", stem="", case_sensitive=True, bounded=False),
    Term("ouble", "ouble"),
    Term("the", "the"),
    Term("the_not_of", "the(?! of)", stem="the"),
    Term("tion", "tion"),
    Term("was", "was"),
    Term("worthless", "worthless"),
]
# Regions: ordered, overlapping needles (NATION_1 also hits NATION_10..19).
REGIONS = [("R1", ["NATION_1"]), ("R2", ["NATION_2"]), ("R10", ["NATION_10"])]
# Ordered title rules for `documents`.
DOC_RULES = [
    (r"(?iu)(?<![\p{L}\p{N}_])worthless(?![\p{L}\p{N}_])", "junk"),
    (r"(?iu)(?<![\p{L}\p{N}_])(?:the|was)(?![\p{L}\p{N}_])", "english"),
    (r"(?iu)(?<![\p{L}\p{N}_])en(?![\p{L}\p{N}_])", "romance"),
]
