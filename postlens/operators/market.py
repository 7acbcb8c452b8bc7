"""Market statistics: aggregations G1-G17, joins J1-J8, windows W1-W4, sorts/top-k T1-T5.

All aggregates are partial + final hash aggregations (map-side combine), so a hot key costs one row per map task
before the shuffle. Totals used as denominators are scalar subqueries (``DataFrame.scalar()``), never cross joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.scalars import col_of, explode_present, midpoint, regex_quote, round_even
from postlens.operators.median import bracket, exact_median
from postlens.operators.ranking import with_rank


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """Count per value, NULL dropped (pandas semantics)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))


def topk(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Ordered limit, planned as TakeOrderedAndProject (per-partition top-k, then a k-row merge)."""
    return df.orderBy(*order).limit(k)


def demand_share(terms: DataFrame, postings: DataFrame, key: str = "job_id", term: str = "skill",
                 k: int | None = None, decimals: int = 1, restrict: bool = True, distinct: bool = True) -> DataFrame:
    """G7 (+T1): distinct postings per term / all postings x 100.

    ``restrict``: keep only bridge rows of the given postings (semi-join); pass False when the bridge was derived
    from exactly these postings. ``distinct``: count distinct postings (a bridge may hold one row per method); pass
    False when (posting, term) pairs are unique by construction, which saves the shuffle of the whole bridge that a
    distinct count needs."""
    total = postings.select(F.count(F.lit(1))).scalar()
    scoped = terms.join(postings.select(key), key, "left_semi") if restrict else terms
    n = F.count_distinct(key) if distinct else F.count(F.lit(1))
    counts = scoped.groupBy(term).agg(n.alias("n"))
    out = counts.select(term, "n", round_even(F.try_divide(F.col("n") * 100.0, total), decimals).alias("share"))
    if k is not None:
        out = topk(out, [F.col("n").desc(), F.col(term)], k)
    return out


def totals(df: DataFrame) -> DataFrame:
    """G1: row count."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def group_counts(df: DataFrame, col: str, null_as: str = "unknown", name: str = "n") -> DataFrame:
    """SQL group count that keeps the NULL group under a label."""
    return df.groupBy(F.coalesce(F.col(col), F.lit(null_as)).alias(col)).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01, name: str = "n") -> DataFrame:
    """Exact distinct count (two-level aggregation) or HyperLogLog++ at a bounded error."""
    agg = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.agg(agg.alias(name))


def median_of(c: str | Column, approx: bool = False, accuracy: int = 100000) -> Column:
    """Median as an aggregate expression (value->count buffer per group, or the fixed-size sketch when ``approx``).
    Operators over data-sized groups use ``grouped_median`` instead, which never holds a whole group in a task."""
    return F.percentile_approx(col_of(c), 0.5, accuracy) if approx else F.median(col_of(c))


def grouped_median(df: DataFrame, by: Sequence[str], value: str | Column, out: str = "median",
                   approx: bool = False, accuracy: int = 100000) -> DataFrame:
    """G5 per group: exact (``exact_median``, skew-safe) or the mergeable quantile sketch."""
    if approx:
        v = col_of(value)
        return df.where(v.isNotNull()).groupBy(*by).agg(F.percentile_approx(v, 0.5, accuracy).alias(out))
    return exact_median(df, by, value, out)


def scalar_median(df: DataFrame, value: str | Column, approx: bool = False) -> Column:
    """The median of a whole frame as a scalar-subquery column (NULL when there is no value)."""
    return grouped_median(df, [], value, "_m", approx).select("_m").scalar()


def median_mid(df: DataFrame, by: Sequence[str] = (), approx: bool = False, decimals: int = 2,
               lo: str = "salary_min", hi: str = "salary_max") -> DataFrame:
    """Median salary midpoint over rows with both bounds (per group when ``by`` is given)."""
    src = df.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).withColumn("_mid", midpoint(lo, hi))
    if by:
        med = grouped_median(src, by, "_mid", "median_mid", approx)
        return med.select(*by, round_even("median_mid", decimals).alias("median_mid"))
    return src.agg(F.count(F.lit(1)).alias("_n")).select(
        round_even(scalar_median(src, "_mid", approx), decimals).alias("median_mid"))


def with_terms(postings: DataFrame, terms: DataFrame, on: str = "job_id") -> DataFrame:
    """Bridge rows joined to their postings (sort-merge on the key; AQE splits skewed partitions)."""
    return terms.join(postings, on)


def term_salary(terms: DataFrame, postings: DataFrame, key: str = "job_id", term: str = "skill", min_n: int = 15,
                k: int | None = 15, approx: bool = False) -> DataFrame:
    """G6 (+P9, T1): median midpoint and count per term over postings with a salary; terms with >= min_n rows."""
    sal = postings.where(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())
    sal = sal.select(key, midpoint().alias("mid"))
    j = with_terms(sal, terms.select(key, term), key)
    if approx:
        g = j.groupBy(term).agg(F.count(F.lit(1)).alias("n"), median_of("mid", True).alias("median_mid"))
    else:  # mid is never NULL here, so the median's value count is the row count
        g = exact_median(j, [term], "mid", "median_mid", count_col="n")
    g = g.where(F.col("n") >= min_n).select(term, round_even("median_mid", 2).alias("median_mid"), "n")
    return topk(g, [F.col("median_mid").desc(), F.col(term)], k) if k else g


def set_share(terms: DataFrame, postings: DataFrame, members: Sequence[str], key: str = "job_id",
              term: str = "skill", decimals: int = 1) -> DataFrame:
    """Distinct postings having any member term / all postings x 100 (NULL when there are no postings)."""
    total = postings.select(F.count(F.lit(1))).scalar()
    hit = terms.where(F.col(term).isin(list(members))).join(postings.select(key), key, "left_semi")
    return hit.agg(F.count_distinct(key).alias("n")).select(
        "n", round_even(F.try_divide(F.col("n") * 100.0, total), decimals).alias("share"))


def _needle_match(loc: Column, needles: Sequence[str]) -> Column:
    alt = "|".join(regex_quote(x) for x in needles)
    return F.coalesce(loc.rlike(f"(?iu)(?:{alt})"), F.lit(False))


def region_hits(loc: str | Column, regions: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """array<string> of every region whose needles the location contains, in dictionary order."""
    c = col_of(loc)
    return F.array_compact(F.array(*[F.when(_needle_match(c, needles), F.lit(name)) for name, needles in regions]))


def region_multi(df: DataFrame, loc: str, regions: Sequence[tuple[str, Sequence[str]]], out: str = "region") -> DataFrame:
    """A row falls into every region whose needles it contains (case-insensitive).

    Expressed as a generator over a literal array instead of a nested-loop join: no exchange, no broadcast, and the
    regions list is a bounded parameter."""
    return df.withColumn(out, F.explode_outer(region_hits(loc, regions))).where(F.col(out).isNotNull())


def region_last(loc: str | Column, regions: Sequence[tuple[str, Sequence[str]]], default: str = "Other") -> Column:
    """Later regions overwrite earlier ones (reverse `when` chain), default otherwise."""
    c = col_of(loc)
    expr = None
    for name, needles in reversed(list(regions)):
        cond = _needle_match(c, needles)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def region_profile(postings: DataFrame, loc: str, regions: Sequence[tuple[str, Sequence[str]]],
                   approx: bool = False) -> DataFrame:
    """Per region n = rows with salary_min, median midpoint over rows with both; regions without a (non-zero)
    median are dropped."""
    r = region_multi(postings, loc, regions).withColumn("_mid", midpoint())
    g = r.groupBy("region").agg(F.count("salary_min").alias("n"))
    med = grouped_median(r, ["region"], "_mid", "median_mid", approx)
    g = g.join(med, "region", "left").select("region", "n", round_even("median_mid", 2).alias("median_mid"))
    return g.where(F.col("median_mid").isNotNull() & (F.col("median_mid") != 0))


def crosstab(df: DataFrame, row: str, col: str, domain: Sequence[str]) -> DataFrame:
    """Row x domain counts, zero-filled; passing the domain avoids a distinct-values job and drops values
    outside it."""
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return src.groupBy(row).pivot(col, list(domain)).agg(F.count(F.lit(1))).fillna(0, subset=list(domain))


def crosstab_pct(df: DataFrame, row: str, col: str, domain: Sequence[str], top: int = 12,
                 decimals: int = 1) -> DataFrame:
    """Crosstab of the ``top`` most frequent rows, each cell as % of the row sum over domain columns."""
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    top_rows = topk(value_counts(src, row, "row_n"), [F.col("row_n").desc(), F.col(row)], top)
    ct = crosstab(src.join(top_rows.select(row), row, "left_semi"), row, col, domain)
    tot = sum((F.col(f"`{d}`") for d in domain), F.lit(0))
    return ct.join(top_rows, row).select(
        row, "row_n", *[round_even(F.try_divide(F.col(f"`{d}`") * 100.0, tot), decimals).alias(d) for d in domain])


def multi_hot(terms: DataFrame, key: str, col: str, kept: Sequence[str]) -> DataFrame:
    """Binary key x term matrix for the kept terms (clip at 1)."""
    return (terms.where(F.col(col).isin(list(kept))).groupBy(key).pivot(col, list(kept))
            .agg(F.max(F.lit(1))).fillna(0, subset=list(kept)))


def term_lists(terms: DataFrame, key: str = "job_id", col: str = "skill") -> DataFrame:
    """Sorted term list per key (bounded by the vocabulary size per key)."""
    return terms.groupBy(key).agg(F.array_sort(F.collect_list(col)).alias("terms"))


def word_freq(df: DataFrame, col: str, stop: Sequence[str] = (), min_len: int = 2) -> DataFrame:
    """Frequency of lower-case [a-z]+ words, minus a stop list."""
    w = explode_present(df, F.regexp_extract_all(F.lower(F.col(col)), F.lit("([a-z]+)"), 1), "word")
    w = w.where(F.length("word") >= min_len)
    if stop:
        w = w.where(~F.col("word").isin(list(stop)))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per date."""
    return df.groupBy(F.to_date(F.col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def daily_growth(df: DataFrame, ts: str) -> DataFrame:
    """Running total of daily counts. The window runs over the aggregated days only (one row per day)."""
    d = daily_counts(df, ts)
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.select("day", "n", F.sum("n").over(w).alias("cumulative"))


def topk_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rk") -> DataFrame:
    """First k rows per group (ties broken by the given order; callers add the key ascending)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= k)


def ranked_regions(profile: DataFrame) -> DataFrame:
    """G9's order: a region profile with each region's ``rank`` by descending count (ties: name)."""
    return with_rank(profile, [F.col("n").desc(), "region"])


def ordered_mix(dense: DataFrame) -> DataFrame:
    """T5's order: re-indexed counts with each value's ``rank`` in the domain."""
    return with_rank(dense, ["ord"])


def latest_n(df: DataFrame, ts: str, key: str, n: int) -> DataFrame:
    """Newest n rows (TakeOrderedAndProject)."""
    return df.orderBy(F.col(ts).desc(), F.col(key)).limit(n)


def head_tail(df: DataFrame, value: str, key: str, head: int = 10, tail: int = 4) -> DataFrame:
    """Top ``head`` and bottom ``tail`` of a ranking, each row once (two bounded top-k, then union)."""
    top = df.orderBy(F.col(value).desc(), F.col(key)).limit(head).withColumn("part", F.lit("head"))
    bottom = df.orderBy(F.col(value).asc(), F.col(key).desc()).limit(tail).withColumn("part", F.lit("tail"))
    both = top.unionByName(bottom)
    return both.groupBy(*[c for c in df.columns]).agg(F.min("part").alias("part"))


def densify(counts: DataFrame, col: str, domain: Sequence[str], value: str = "n") -> DataFrame:
    """J8 + T5: counts re-indexed to an ordinal domain (missing -> 0, values outside vanish) with its order."""
    spark = counts.sparkSession
    dom = spark.createDataFrame([(v, i) for i, v in enumerate(domain)], f"{col} string, ord int")
    return (F.broadcast(dom).join(counts, col, "left")
            .select(col, "ord", F.coalesce(F.col(value), F.lit(0)).cast("long").alias(value)))


def left_zero(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Left join, missing values -> 0."""
    cols = [c for c in other.columns if c != on]
    return df.join(other, on, "left").fillna(0, subset=cols)


_SEG = "array<struct<dim:string,segment:string>>"


def _seg(dim: str, segment: Column) -> Column:
    return F.struct(F.lit(dim).alias("dim"), segment.alias("segment"))


def segments(postings: DataFrame, regions: Sequence[tuple[str, Sequence[str]]], levels: Sequence[str],
             key: str = "job_id", carry: Sequence[str] = ()) -> DataFrame:
    """Long (key, carry..., dim, segment) frame for the four segment dimensions (seniority, region, source, remote).

    One pass over the postings: each row builds the array of its (dim, segment) pairs (a row may fall into several
    regions) and the array is exploded, instead of a union of one scan per dimension."""
    sen = F.when(F.col("seniority").isin(list(levels)), F.array(_seg("Seniority", F.initcap("seniority"))))
    reg = F.transform(region_hits("location", regions), lambda r: _seg("Metro area", r))
    src = F.array(_seg("Source", F.initcap("source")))
    rem = F.array(_seg("Remote vs onsite", F.when(F.col("remote").eqNullSafe(True), F.lit("Remote"))
                       .otherwise(F.lit("Onsite / unspecified"))))
    pairs = F.concat(F.coalesce(sen, F.array().cast(_SEG)), reg, src, rem)
    return explode_present(postings, pairs, "_s", key, *carry).select(key, *carry, "_s.dim", "_s.segment")


def flagged_terms(postings: DataFrame, terms: DataFrame, key: str = "job_id", term: str = "skill") -> DataFrame:
    """Postings left-joined to their terms: a row for each term, or one row. ``_linked`` tells whether the row has a bridge
    row; ``_first`` is true on exactly one row of each posting, so sums over it count postings."""
    w = Window.partitionBy(key).orderBy(term)
    bridge = terms.select(key, term, (F.row_number().over(w) == 1).alias("_one"))
    return (postings.join(bridge, key, "left").withColumn("_linked", F.col("_one").isNotNull())
            .withColumn("_first", F.coalesce("_one", F.lit(True))).drop("_one"))


def group_profile(rows: DataFrame, by: Sequence[str], value: str, term: str, k: int, approx: bool = False) -> DataFrame:
    """Statistics of groups of ``flagged_terms`` rows: (by..., n postings, n_with of them that have a term, median of
    ``value``, tops: array of the ``k`` most frequent terms as (rk, term, cnt), ties by term).

    One grouping-sets pass counts terms and values together, and one aggregate gives sizes and brackets for the exact median
    (as in ``exact_median``). From there on terms and values are rows of one table: one window ranks both. A group of NULLs
    is a group; NULL values count in ``n`` alone."""
    by = list(by)
    rows = rows.select(*by, F.col(value).cast("double").alias("_v"), F.col(term).alias("_term"), "_linked", "_first")
    own = F.when(F.col("_first"), F.col("_v"))
    sizes = rows.groupBy(*by).agg(
        F.count_if("_first").alias("n"), F.count_if(F.col("_first") & F.col("_linked")).alias("n_with"), F.count(own).alias("_n"),
        (F.percentile_approx(own, 0.5, 100000) if approx else F.lit(None).cast("double")).alias("_approx"), bracket(own).alias("_b"))
    cols = [F.col(c) for c in by]
    both = rows.groupingSets([[*cols, F.col("_term")], [*cols, F.col("_v")]], *cols, F.col("_term"), F.col("_v")).agg(
        F.grouping("_term").alias("_values"), F.count_if("_linked").alias("_cnt"), F.count_if("_first").alias("_c"))
    both = both.where("_values = 1 OR _cnt > 0")
    on = F.lit(True)
    for c in by:
        on = on & both[c].eqNullSafe(sizes[c])
    both = both.join(sizes, on).select(
        *[both[c] for c in by], "n", "n_with", "_n", "_approx", "_values", "_term", "_v", F.when(F.col("_values") == 0, F.col("_cnt")).alias("_cnt"),
        F.when(F.col("_values") == 1, F.col("_c")).alias("_c"), F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"))
    inside = both.where(F.coalesce(F.col("_v") <= F.col("_hi"), F.lit(True))).withColumn("_in", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")))
    inside = inside.groupBy(*by, "n", "n_with", "_n", "_approx", "_values", "_term", "_in").agg(
        F.max("_cnt").alias("_cnt"), F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))).alias("_c"))
    order = Window.partitionBy(*by, "_values").orderBy(F.col("_cnt").desc(), "_term", F.col("_in").asc_nulls_first())
    placed = inside.withColumn("_rk", F.row_number().over(order).cast("long")).withColumn(
        "_end", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("_end") > F.expr(rank), F.col("_in")))

    listed = F.when((F.col("_values") == 0) & (F.col("_rk") <= k), F.struct(F.col("_rk").alias("rk"), F.col("_term").alias("term"), F.col("_cnt").alias("cnt")))
    med = F.first("_approx") if approx else (at("(_n - 1) div 2") + at("_n div 2")) / 2
    return placed.groupBy(*by, "n", "n_with").agg(med.alias("median"), F.array_sort(F.collect_list(listed)).alias("tops"))


def segment_profile(postings: DataFrame, terms: DataFrame, regions: Sequence[tuple[str, Sequence[str]]],
                    levels: Sequence[str], min_n: int = 5, k: int = 6, key: str = "job_id", term: str = "skill",
                    approx: bool = False) -> DataFrame:
    """Per segment of every dimension: size, median midpoint, top-k terms with % of the segment's postings
    that have at least one term, from one ``group_profile`` instead of a loop over segments."""
    facts = flagged_terms(postings.withColumn("mid", midpoint()), terms, key, term)
    rows = segments(facts, regions, levels, key, carry=["mid", term, "_linked", "_first"])
    prof = group_profile(rows, ["dim", "segment"], "mid", term, k, approx).where(F.col("n") >= min_n)
    prof = prof.select("dim", "segment", "n", "n_with", "median", F.explode_outer("tops").alias("t"))
    return prof.select("dim", "segment", "n", round_even("median", 2).alias("median_mid"), "t.rk", F.col("t.term").alias(term),
                       round_even(F.col("t.cnt") * 100.0 / F.col("n_with"), 1).alias("pct"))
