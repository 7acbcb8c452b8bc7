"""Deduplication and set operators D1-D5, W3.

First-wins per key is an aggregation (``min`` over a struct whose leading fields are the order columns), not a
window: the aggregate combines map-side, so a key holding a third of all rows collapses to one row per map task
before the shuffle instead of landing whole in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.predicates import has_text


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order`` (remaining columns break exact ties deterministically)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    lead = list(order) + [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(lead)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first._{i}").alias(c) for i, c in enumerate(lead)]).select(*df.columns)


def dedup_append(existing: DataFrame, batch: DataFrame, key: str, order: Sequence[str], text: str) -> DataFrame:
    """Rows of ``batch`` to append: non-empty ``text``, key unseen in ``existing``, first per key in feed order.

    An empty first copy does not block a later full one (empties are dropped before picking the first).

    The stored table is only probed: its key column is semi-joined against the batch's keys (the side the planner may
    broadcast, after its size check, when the batch is a small increment), and the batch is then anti-joined against
    those few known keys. A plain ``batch left_anti table`` could only broadcast the table side, so every increment
    would shuffle all stored keys."""
    candidates = batch.where(has_text(text))
    known = existing.select(key).join(candidates.select(key), key, "left_semi")
    unseen = candidates.join(known, key, "left_anti")
    return first_per_key(unseen, key, order)


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """D3: keys occurring more than once (an empty result means the key is unique)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def distinct_terms(c: str | Column) -> Column:
    """Distinct items of an array."""
    return F.array_distinct(F.col(c) if isinstance(c, str) else c)


def set_diff(df: DataFrame, pred: str, gold: str) -> DataFrame:
    """Per-row intersection and both differences of two term arrays (sorted)."""
    return df.withColumns({
        "common": F.array_sort(F.array_intersect(pred, gold)),
        "spurious": F.array_sort(F.array_except(pred, gold)),
        "missed": F.array_sort(F.array_except(gold, pred)),
    })


def flag_new(existing: DataFrame, batch: DataFrame, key: str, order: Sequence[str], text: str, source: str) -> DataFrame:
    """D1 that flags instead of filtering: per key and source of ``batch`` its rows, and whether ``dedup_append`` takes the
    key's row from that source (is_new). One pass over the batch: rows meet in (key, source) before anything is shuffled, and
    the window that picks a key's source runs over one row a source."""
    best = F.min(F.when(has_text(text), F.struct(*[F.col(c) for c in order], F.col(source).alias("_source"))))
    per = batch.groupBy(key, source).agg(F.count(F.lit(1)).alias("rows"), best.alias("_best"))
    known = existing.select(key).join(per.select(key), key, "left_semi").distinct().withColumn("_known", F.lit(True))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.col("_best").asc_nulls_last())) == 1
    return per.join(known, key, "left").withColumn(
        "is_new", first & F.col("_best").isNotNull() & F.col("_known").isNull()).select(key, source, "rows", "is_new")
