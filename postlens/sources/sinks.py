"""Sinks and state changes K1-K7 plus artefact read/write.

Tables are Parquet folders. Re-running a sink with the same input leaves the table unchanged (key-based idempotence).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.operators.dedup import dedup_append, first_per_key
from postlens.session import delete_folder


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str | None, empty: StructType | str | None = None) -> DataFrame:
    """A Parquet table, or an empty frame with ``schema`` when nothing has been written yet. With ``schema`` None the
    stored schema is read, and ``empty`` is the one of the empty frame. Any other error is raised."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema if schema is not None else empty)


def key_bucket(key: str, buckets: int) -> Column:
    """Stable bucket of a key (independent of partitioning and of the Spark version's hash partitioner)."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def append_new(spark: SparkSession, path: str, batch: DataFrame, key: str, order: Sequence[str], text: str,
               partition_by: Sequence[str] = ("source",), buckets: int | None = None) -> DataFrame:
    """K1: append the unseen, non-empty, first-per-key rows of ``batch`` to the table at ``path``.

    With ``buckets`` the table is also partitioned by ``bucket = pmod(xxhash64(key), buckets)``: an increment then
    reads only the buckets its keys fall into (static partition pruning on at most ``buckets`` small integers),
    instead of every stored key. The new rows are materialised (reliable checkpoint in the shared checkpoint folder)
    before the write, so the returned frame stays the appended rows even after the table has changed and survives
    executor loss."""
    parts = list(partition_by)
    if buckets:
        batch = batch.withColumn("bucket", key_bucket(key, buckets))
        parts.append("bucket")
    existing = read_or_empty(spark, path, batch.schema)
    if buckets:
        touched = [r[0] for r in batch.select("bucket").distinct().collect()]  # at most ``buckets`` integers
        existing = existing.where(F.col("bucket").isin(touched))
    new = dedup_append(existing, batch, key, order, text).checkpoint(eager=True)
    new.write.mode("append").partitionBy(*parts).parquet(path)
    return new


def replace_by_key(target: DataFrame, new: DataFrame, key: str, method: str | None = None,
                   method_col: str = "method", processed: DataFrame | None = None) -> DataFrame:
    """K2: drop the target rows of every processed key (only rows of ``method`` when given), add ``new``.

    ``processed`` holds the keys that were worked on; a key that yielded nothing loses its old rows too. Without it the
    keys of ``new`` count as the processed ones. One scan of the target: a left join flags the rows to drop."""
    keys = new.select(key) if processed is None else processed.select(key).unionByName(new.select(key))
    keys = keys.distinct().withColumn("_hit", F.lit(True))
    t = target.join(keys, key, "left")
    drop = F.col("_hit").isNotNull()
    if method is not None:
        drop = drop & F.col(method_col).eqNullSafe(F.lit(method))
    kept = t.where(~drop).drop("_hit")
    return kept.unionByName(new.select(*target.columns))


def replace_by_key_table(spark: SparkSession, path: str, new: DataFrame, key: str, method: str | None = None,
                         buckets: int = 64, method_col: str = "method", processed: DataFrame | None = None) -> None:
    """K2 on a stored table bucketed by ``pmod(xxhash64(key), buckets)``: only buckets with processed keys are rewritten
    (dynamic partition overwrite; a bucket left without rows is removed). The rewrite is checkpointed first because it
    reads those buckets. The stored columns must be those of ``new``; anything else raises."""
    new_b = new.withColumn("bucket", key_bucket(key, buckets))
    target = read_or_empty(spark, path, None, new_b.schema)
    if set(target.columns) != set(new_b.columns):
        raise ValueError(f"the table has columns {sorted(target.columns)}, the new rows {sorted(new_b.columns)}")
    keys = new.select(key) if processed is None else processed.select(key).unionByName(new.select(key))
    touched = keys.select(key_bucket(key, buckets).alias("bucket")).distinct()
    affected = target.join(touched, "bucket", "left_semi")
    rewritten = replace_by_key(affected, new_b, key, method, method_col, processed).checkpoint(eager=True)
    overwrite_buckets(spark, path, rewritten, touched)


def overwrite_buckets(spark: SparkSession, path: str, rows: DataFrame, touched: DataFrame) -> None:
    """Put ``rows`` in place of all rows of the ``touched`` (bucket) buckets of the table at ``path``; a bucket left without
    rows is removed. ``rows`` must be stored elsewhere, since the table's own files go; doing it again changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    empty = touched.join(rows.select("bucket").distinct(), "bucket", "left_anti").collect()  # at most one integer a bucket
    for r in empty:
        delete_folder(spark, f"{path}/bucket={r[0]}")


def fill_if_missing(df: DataFrame, col: str, expr: Column) -> DataFrame:
    """K3: set ``col`` only where it is NULL or ''."""
    return df.withColumn(col, F.coalesce(F.nullif(F.col(col), F.lit("")), expr))


def update_by_key(target: DataFrame, upd: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """K4: overwrite ``cols`` for matched keys, even with NULL. Of several updates of one key the smallest by ``cols`` (NULL
    first) holds, so no target row is multiplied."""
    u = first_per_key(upd.select(key, *cols), key, cols).select(key, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_m"))
    j = target.join(u, key, "left")
    out = j.select(*[F.when(F.col("_m"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                     for c in target.columns])
    return out


def write_artifact(df: DataFrame, path: str) -> None:
    """K5: write a one-row nested result as JSON (one small file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_artifact(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The artefact if present, else an empty frame with the declared schema."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ingest_report(batch: DataFrame, new: DataFrame, source: str = "source",
                  stored: Column | None = None) -> DataFrame:
    """K6: per source new and skipped (duplicate or empty) rows, plus an 'ALL' total row; with ``stored`` (the row
    count of the table before the append, a scalar column) also the table size after it.

    The size after the append is taken from the per-source rows (a sum over one row per source), so the new rows are
    derived once: a separate count of ``new`` would be a second, differently pruned pass over the batch."""
    b = batch.groupBy(source).agg(F.count(F.lit(1)).alias("rows"))
    n = new.groupBy(source).agg(F.count(F.lit(1)).alias("new_rows"))
    per = b.join(n, source, "left").select(
        source, F.coalesce("new_rows", F.lit(0)).alias("new_rows"),
        (F.col("rows") - F.coalesce("new_rows", F.lit(0))).alias("skipped"))
    tot = per.agg(F.lit("ALL").alias(source), F.sum("new_rows").alias("new_rows"), F.sum("skipped").alias("skipped"))
    out = per.unionByName(tot)
    if stored is not None:
        # the window spans the report rows only (one per source plus the total)
        added = F.max(F.when(F.col(source) == "ALL", F.col("new_rows"))).over(Window.partitionBy())
        out = out.withColumn("table_total", stored + added)
    return out


def flagged_report(flags: DataFrame, source: str = "source", stored: Column | None = None) -> DataFrame:
    """K6 from ``dedup.flag_new``: one rollup gives the sources' new and skipped rows and the 'ALL' row; with ``stored`` also the
    table's size after the append."""
    new = F.sum(F.col("is_new").cast("long"))
    out = flags.rollup(source).agg(F.grouping_id().alias("_all"), new.alias("new_rows"), (F.sum("rows") - new).alias("skipped"))
    out = out.select(F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col(source)).alias(source), "new_rows", "skipped", "_all")
    if stored is not None:
        added = F.max(F.when(F.col("_all") == 1, F.col("new_rows"))).over(Window.partitionBy())  # over the report's rows only
        out = out.withColumn("table_total", stored + added)
    return out.drop("_all")


def extract_report(terms: DataFrame, postings: DataFrame) -> DataFrame:
    """K7: tag rows, postings, average tags per posting (denominator at least 1)."""
    rows = terms.select(F.count(F.lit(1))).scalar()
    return postings.agg(F.count(F.lit(1)).alias("postings")).select(
        rows.alias("tag_rows"), "postings",
        F.bround(rows / F.greatest(F.col("postings"), F.lit(1)), 1).alias("avg_per_posting"))
