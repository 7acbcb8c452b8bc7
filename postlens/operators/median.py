"""Exact per-group median in one lazy plan, without a group ever standing in one task.

Rows are first counted by (group, value), so a value that fills half a group is one row. A mergeable quantile sketch of
the group, whose rank error is at most n / ``ACCURACY``, gives two values that surely enclose the middle ranks. Counts
below them are summed, and only the distinct values between them (about 1 / 1,000 of the group's rows at most, besides
ties) are put in order to read the middle ranks exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_KEY = "_grp"
#: The sketch's rank error is n / ACCURACY; the bracket leaves twice that on either side of the middle.
ACCURACY = 4_000


def bracket(value: str | Column) -> Column:
    """Aggregate: two values of a group that surely enclose its middle ranks."""
    reach = 2 / ACCURACY
    return F.percentile_approx(value, [0.5 - reach, 0.5 + reach], ACCURACY)


def exact_median(df: DataFrame, by: Sequence[str], value: str | Column, out: str = "median",
                 count_col: str | None = None) -> DataFrame:
    """(by..., out[, count_col]) with the interpolated median of ``value`` per group; NULL values are ignored, groups
    without a value are absent (join back with a left join to get NULL). Nothing runs while the plan is made."""
    by = list(by)
    keys = by or [_KEY]  # without groups everything is one, and its bracket and size come as a scalar subquery
    v = F.col(value) if isinstance(value, str) else value
    src = df.select(*[F.col(c) for c in by], v.cast("double").alias("_v"))
    if not by:
        src = src.withColumn(_KEY, F.lit(0))
    src = src.where(F.col("_v").isNotNull())
    counts = src.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    state = src.groupBy(*keys).agg(bracket("_v").alias("_b"), F.count(F.lit(1)).alias("_n"))
    if by:
        on = counts[keys[0]].eqNullSafe(state[keys[0]])
        for k in keys[1:]:
            on = on & counts[k].eqNullSafe(state[k])
        both = counts.join(state, on).select(*[counts[k] for k in keys], "_v", "_c", "_n", F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"))
    else:
        of = state.select(F.struct("_n", "_b").alias("s")).scalar()
        both = counts.select(_KEY, "_v", "_c", of["_n"].alias("_n"), of["_b"][0].alias("_lo"), of["_b"][1].alias("_hi"))
    below = F.when(F.col("_v") < F.col("_lo"), F.col("_c")).otherwise(0)
    # counts below the bracket are one row a group after this aggregate; values above it are not needed
    inside = both.where(F.col("_v") <= F.col("_hi")).withColumn("_in", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")))
    inside = inside.groupBy(*keys, "_n", "_in").agg(F.sum(below).alias("_below"), F.sum(F.when(F.col("_in").isNotNull(), F.col("_c")).otherwise(0)).alias("_c"))
    order = Window.partitionBy(*keys).orderBy(F.col("_in").asc_nulls_first())
    end = F.sum(F.col("_c") + F.col("_below")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = inside.withColumn("_end", end).where(F.col("_in").isNotNull())
    first, second = F.expr("(_n - 1) div 2"), F.expr("_n div 2")

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_end") > rank, F.col("_in")))

    res = placed.groupBy(*keys, "_n").agg(((at(first) + at(second)) / 2).alias(out))
    res = res.withColumnRenamed("_n", count_col) if count_col else res.drop("_n")
    return res if by else res.drop(_KEY)
