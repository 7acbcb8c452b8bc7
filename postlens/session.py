"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "postlens", shuffle_partitions: int | None = None) -> SparkSession:
    """Session tuned for the engine: AQE on (coalescing + skew join), UTC, no UI server.

    On a cluster, ``master`` stays None and the launcher's settings win; partition counts are left to AQE.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    parts = shuffle_partitions or os.environ.get("POSTLENS_SHUFFLE_PARTITIONS")
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("POSTLENS_DRIVER_MEMORY", "16g"))
    )
    if parts:  # else the launcher's number stands
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a fresh scratch folder, and any other raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="postlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables and streaming state."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def _at(spark: SparkSession, path: str):
    """A path and the file system that it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder; one that is there stays as it is."""
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
