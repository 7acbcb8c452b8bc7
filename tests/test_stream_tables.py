"""Streams over tables that are one file or a folder of part files."""

import glob
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from postlens.session import folder_bytes, scratch_path


@pytest.fixture(scope="module")
def tables(spark, sf):
    """The small tables, each in a folder of three part files; the dimensions stay as they are."""
    base = scratch_path(spark, f"tables-{uuid.uuid4().hex}")
    for name in ("events", "documents", "orders"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(3).write.parquet(f"{base}/{name}.parquet")
    for name in ("customer", "nation", "region"):
        shutil.copy(f"{sf}/{name}.parquet", base)
    assert len(glob.glob(f"{base}/documents.parquet/part-*")) == 3
    return base


@pytest.mark.parametrize("name", ["stream_tag", "stream_dedup", "stream_daily", "stream_ingest"])
def test_a_folder_of_part_files_streams_like_one_file(spark, sf, tables, name):
    query = entry.queries()[name]
    want, got = query(spark, sf), query(spark, tables)
    assert got.count() > 0
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_alerts_from_a_folder(spark, tables):
    got = entry.queries()["stream_alert"](spark, tables).agg(F.sum("matched")).first()[0]
    assert got == spark.read.parquet(f"{tables}/orders.parquet").where("o_orderpriority in ('5-LOW', '3-MEDIUM')").count()


def test_landed_files_grow_with_the_table(spark, sf):
    from postlens.plans import q_stream

    size = max(folder_bytes(spark, f"{sf}/{n}.parquet") for n in ("events", "documents"))
    assert q_stream._parts(spark, sf, "events", "documents") == 1
    parts = q_stream._parts(spark, sf, "events", "documents", file_bytes=size // 12)
    assert 4 <= parts <= 5
    base = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    for n in (1, parts):
        q_stream._land(spark.range(100).select(F.to_json(F.struct("id"))), base, n, n)
        assert spark.read.text(f"{base}/delivery-{n}").count() == 100
        assert len(glob.glob(f"{base}/delivery-{n}/part-*")) == 3 * n


def test_more_files_land_the_same_postings(spark, sf, monkeypatch):
    from postlens.plans import q_stream

    query = entry.queries()["stream_feeds"]
    want = query(spark, sf)
    monkeypatch.setattr(q_stream, "_parts", lambda *a: 3)
    got = query(spark, sf)
    assert got.count() > 0 and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
