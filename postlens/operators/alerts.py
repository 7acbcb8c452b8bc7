"""Alert and feed queries A1-A4.

Everything is a filter plus a bounded top-k (TakeOrderedAndProject); totals are separate aggregates, so no global
window or single-partition sort is ever needed over the matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.predicates import any_of, is_true, search, since
from postlens.functions.scalars import day_label, falsy, midpoint, salary_band
from postlens.operators.market import median_mid, set_share
from postlens.operators.ranking import with_rank


def find_matches(df: DataFrame, as_of: str, hours: int, levels: Sequence[str], ts: str = "ingested_at") -> DataFrame:
    """A1: postings ingested within the look-back window at the given levels; ``newest_first`` puts them in order."""
    return df.where(since(ts, as_of, hours) & any_of("seniority", levels))


def newest_first(matches: DataFrame, ts: str = "ingested_at", key: str = "job_id") -> DataFrame:
    """A1's order: matches with their ``rank`` from the newest on (ties: key)."""
    return with_rank(matches, [F.col(ts).desc(), key])


def feed_filter(df: DataFrame, needle: str | None = None, levels: Sequence[str] = (), remote_only: bool = False,
                salary_only: bool = False) -> DataFrame:
    """A2 filters: search needle, levels, remote == True, both salary bounds present."""
    out = search(df, needle)
    if levels:
        out = out.where(any_of("seniority", levels))
    if remote_only:
        out = out.where(is_true("remote"))
    if salary_only:
        out = out.where(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())
    return out


def feed_page(df: DataFrame, needle: str | None = None, levels: Sequence[str] = (), remote_only: bool = False,
              salary_only: bool = False, n: int = 200, ts: str = "ingested_at", key: str = "job_id") -> DataFrame:
    """A2: newest ``n`` matching postings with display columns."""
    f = feed_filter(df, needle, levels, remote_only, salary_only)
    page = f.orderBy(F.col(ts).desc(), F.col(key)).limit(n)
    return page.select(key, "title", "company", "location", "seniority", salary_band().alias("salary"),
                       day_label(ts).alias("added"))


def feed_total(df: DataFrame, needle: str | None = None, levels: Sequence[str] = (), remote_only: bool = False,
               salary_only: bool = False) -> DataFrame:
    """A2: number of matches before the page limit."""
    return feed_filter(df, needle, levels, remote_only, salary_only).agg(F.count(F.lit(1)).alias("matched"))


def headline(postings: DataFrame, terms: DataFrame, full_text: DataFrame, members: Sequence[str]) -> DataFrame:
    """A3: tracked postings, postings with salary, share of full-text postings with any member term, median."""
    counts = postings.agg(
        F.count(F.lit(1)).alias("postings"),
        F.count_if(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()).alias("with_salary"))
    share = set_share(terms, full_text, members).select(F.col("share").alias("member_share"))
    med = median_mid(postings)
    # three one-row aggregates side by side: each is a scalar subquery of the final projection
    return counts.select(
        "postings", "with_salary",
        share.select("member_share").scalar().alias("member_share"),
        med.select("median_mid").scalar().alias("median_mid"))


def digest_line() -> F.Column:
    """One alert line: '• title — company (where) · $NNk' (salary only when both bounds are non-zero)."""
    where = F.coalesce(F.nullif(F.col("location"), F.lit("")),
                       F.when(F.col("remote").eqNullSafe(True), F.lit("remote")).otherwise(F.lit("")))
    both = F.coalesce((F.col("salary_min") != 0) & (F.col("salary_max") != 0), F.lit(False))
    sal = F.when(both, F.concat(F.lit(" · $"), F.format_string("%.0f", F.bround((F.col("salary_min") + F.col("salary_max")) / 2000, 0)), F.lit("k")))
    return F.concat(F.lit("• "), F.col("title"), F.lit(" — "), falsy("company", "?"), F.lit(" ("), where, F.lit(")"),
                    F.coalesce(sal, F.lit("")))


def digest(matches: DataFrame, n: int = 8, ts: str = "ingested_at", key: str = "job_id") -> DataFrame:
    """A4: one-row digest: header with count and plural, first ``n`` lines (newest first), '…and N more'.

    The n lines come from a distributed top-k; only n rows are collected into the array."""
    total = matches.select(F.count(F.lit(1))).scalar()
    top = matches.orderBy(F.col(ts).desc(), F.col(key)).limit(n).select(
        F.struct(F.col(ts).alias("ts"), F.col(key).alias("key"), digest_line().alias("line")).alias("s"))
    lines = F.array_sort(F.collect_list("s"), lambda a, b: F.when(a["ts"] > b["ts"], -1).when(a["ts"] < b["ts"], 1)
                         .when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    body = F.array_join(F.transform(lines, lambda s: s["line"]), "\n")
    more = F.when(total > n, F.concat(F.lit("\n…and "), (total - n).cast("string"), F.lit(" more"))).otherwise("")
    header = F.concat(total.cast("string"), F.lit(" new opening"), F.when(total > 1, "s").otherwise(""))
    return top.agg(body.alias("body")).where(total > 0).select(
        header.alias("header"), total.cast("long").alias("matched"), F.concat("body", more).alias("message"))
