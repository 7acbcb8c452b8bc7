"""A total order over all rows whose place is a column (T4, T5 and the orders of G9 and A1), without a single-task window.

Rows are dealt by range and sorted inside partitions; a row's place is the number of rows in the partitions before its own, plus
its place there. Only one number a partition is summed up across partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import checkpoint_dir


def with_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank", first: int = 1) -> DataFrame:
    """``df`` with each row's place in ``order``, counted from ``first``. Rows that ``order`` doesn't tell apart get places of
    their own in any order, so an order that ends with a key gives the same ranks every time. An empty frame has none.

    The sorted rows are written once (checkpoint), so places and partition sizes are of the same run."""
    checkpoint_dir(df.sparkSession)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    # the id counts the rows of a partition in its lower 33 bits, and holds the partition's number above them
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    placed = placed.checkpoint(eager=True)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.col("_at") + first).drop("_part", "_at", "_start")
