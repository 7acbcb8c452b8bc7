"""Column-projected table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# Natural key of the fact tables: a fact table that scans into fewer splits than the cluster has cores is spread by it.
TABLE_KEYS = {
    "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "conversations": "conv_id",
}


def spread(df: DataFrame, key: str | None = None, parallelism: int | None = None) -> DataFrame:
    """Small-input guard: a Parquet row group is never split, so a small file written as one row group scans in one
    task and every expression above it (regex tagging, tokenising) would run on one core. When the scan has fewer
    splits than ``parallelism`` (default: the cluster's cores) the rows are spread over that many partitions right after
    the scan (by a hash of ``key``, see below); column pruning and pushed filters still reach the scan below the exchange. A large input already has more
    splits than cores and is returned unchanged (no shuffle is added at scale).

    The rows are placed by ``xxhash64(key)``, not by ``key`` itself, so this exchange never stands in for a later
    key-clustered one: aggregations and joins above keep the exchanges they have at scale, and those exchanges stay
    shareable (ReuseExchange) between branches of one plan."""
    if df.isStreaming:
        return df
    n = parallelism or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:  # planning only: split computation, no job
        return df
    return df.repartition(n, F.xxhash64(key)) if key else df.repartition(n)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Catalyst prunes columns and pushes filters into the Parquet scan. Fact tables go through
    the small-input guard (``spread``)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return spread(df, TABLE_KEYS[name]) if name in TABLE_KEYS else df


def scan(spark: SparkSession, path: str, cols: Sequence[str] | None = None, not_null: Sequence[str] = ()) -> DataFrame:
    """Projected scan with an optional NOT NULL conjunction (pushed down as IsNotNull filters)."""
    df = spark.read.parquet(path)
    if cols:
        df = df.select(*cols)
    for c in not_null:
        df = df.where(F.col(c).isNotNull())
    return df


def scan_pending(df: DataFrame, flag: str, order_by: Sequence[str | Column], limit: int | None = None) -> DataFrame:
    """Rows whose work marker IS FALSE (NULL excluded); optional ordered limit (the reference's is unordered)."""
    out = df.where(F.col(flag) == F.lit(False))
    if limit is not None:
        out = out.orderBy(*order_by).limit(limit)
    return out


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keyed lookup as a left-semi join. The planner broadcasts ``keys`` only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime); otherwise sort-merge."""
    return df.join(keys, on=on, how="left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows without a partner."""
    return df.join(keys, on=on, how="left_anti")


def snapshot(df: DataFrame) -> DataFrame:
    """Memoise a table for a dashboard session; callers ``unpersist`` to refresh instead of a TTL."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
