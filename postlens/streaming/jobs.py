"""Structured Streaming jobs R1-R5.

Each job reads a file stream with a declared schema, keeps its progress in a checkpoint folder under the shared
``spark.checkpoint.dir`` (so a restarted query resumes after executor or driver loss), and writes to Parquet tables.
``availableNow`` drains what has landed and stops, which is how the scheduled runs of the reference map onto streams.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postlens.operators.alerts import digest
from postlens.session import is_file
from postlens.sources.feeds import POSTING_DDL, FeedSpec, landed_feeds
from postlens.sources.sinks import append_new, read_or_empty


def file_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A Parquet file stream over a table, be it a folder of part files or one file (e.g. '.../events.parquet').

    A file stream reads folders only: of a single file it reads the folder around it, for files of that name."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if not is_file(spark, path):
        return r.parquet(path)
    folder, name = path.rsplit("/", 1)
    return r.option("pathGlobFilter", name).parquet(folder)


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_ingest(stream: DataFrame, target: str, key: str, order: Sequence[str], text: str, checkpoint: str,
                  partition_by: Sequence[str] = ("source",), buckets: int | None = None) -> None:
    """Every micro-batch goes through D1 + K1 against the stored table: a key is appended once, whichever batch
    (or retried batch) brings it. With ``buckets`` a micro-batch reads only the key buckets it touches."""
    spark = stream.sparkSession

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # its buckets, its keys and its rows: several passes over one micro-batch
        try:
            append_new(spark, target, batch, key, order, text, partition_by, buckets)
        finally:
            batch.unpersist()

    _run(stream.writeStream.foreachBatch(per_batch), checkpoint)


def stream_feeds(spark: SparkSession, landings: Sequence[tuple[str, FeedSpec]], target: str, checkpoint: str,
                 max_files: int | None = None, buckets: int | None = 64) -> DataFrame:
    """S1-S5 and R1 together: JSON files that landed in the feeds' folders are conformed, united in feed order and appended to
    ``target``, each source_id once. Of several copies the one of the earliest micro-batch stays, within one that of the first
    feed, then file, then place; copies without description don't count. Returns the stored table.

    A run reads what landed since the last one (kept in ``checkpoint``) and stops; ``max_files`` bounds what a micro-batch takes
    of each feed. ``landings`` must stay the same from run to run."""
    stream_ingest(landed_feeds(spark, landings, max_files), target, "source_id", ["feed_ord", "page", "pos"], "description",
                  checkpoint, buckets=buckets)
    return read_or_empty(spark, target, None, POSTING_DDL)


def stream_dedup(stream: DataFrame, ts: str, key: Sequence[str], delay: str, path: str, checkpoint: str) -> None:
    """R2: bounded-state dedup: a key is dropped when seen again within ``delay`` of event time (exactness beyond the
    watermark stays with R1's anti-join)."""
    d = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    d = d.dropDuplicatesWithinWatermark(list(key))
    _run(d.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def stream_project(stream: DataFrame, fn: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Stateless projections (tagger, classifier) run unchanged on a stream."""
    _run(fn(stream).writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def stream_alert(stream: DataFrame, match: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 n: int = 8, ts: str = "ingested_at", key: str = "job_id") -> None:
    """One digest per micro-batch, in a folder of the batch's own under ``path``; a batch that is replayed after a
    crash overwrites its folder, so each matching row is alerted once."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # counted and sorted: two passes
        try:
            digest(batch, n, ts, key).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    _run(match(stream).writeStream.foreachBatch(per_batch), checkpoint)


def stream_daily(stream: DataFrame, ts: str, path: str, checkpoint: str, delay: str = "1 day") -> None:
    """Daily counts with a watermark, complete output re-written per micro-batch (state = one row per day).

    A ``timestamp_ntz`` event time is windowed as it is (days of its own wall clock, whatever the session time zone);
    the watermark needs a zoned timestamp, so it is declared on a cast copy."""
    if dict(stream.dtypes)[ts] == "timestamp_ntz":
        s = stream.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    else:
        s = stream.withWatermark(ts, delay)
    agg = s.groupBy(F.window(ts, "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.to_date(F.col("w.start")).alias("day"), "n").write.mode("overwrite").parquet(path)

    _run(agg.writeStream.outputMode("complete").foreachBatch(per_batch), checkpoint)


def growth_from_daily(daily: DataFrame) -> DataFrame:
    """Running total at read time over the daily table (one row per day)."""
    from pyspark.sql import Window
    win = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("day", "n", F.sum("n").over(win).alias("cumulative"))
