"""Helpers that several operators of this subpackage share: scratch tables, 64-bit hashing in numpy, words, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import scratch_path

U64 = np.uint64
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2D
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: ASCII white space separates words; A-Z become a-z; every other byte stands for itself.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Letters, digits and all bytes beyond ASCII; and with marks as words of their own.
ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)]).astype(np.uint8)
ALNUM_MARKS = np.where(ALNUM > 0, 1, np.where(SPACE, 0, 2)).astype(np.uint8)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def kept_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back: lineage ends there, and a lost
    executor costs only the tasks that it ran."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, element by element."""
    x = x + _M1
    x = (x ^ (x >> U64(30))) * _M2
    x = (x ^ (x >> U64(27))) * _M3
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand; they make hashes of ranges from one
    running sum."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            step = np.full(size, _BASE, U64)
            step[0] = 1
            self.up = np.cumprod(step)
            step = np.full(size, _BASE_INV, U64)
            step[0] = 1
            self.down = np.cumprod(step)

    def running(self, x: np.ndarray) -> np.ndarray:
        """Prefix sums of x[i] * base**i, with a leading zero."""
        self.need(len(x) + 1)
        out = np.zeros(len(x) + 1, U64)
        np.cumsum(x * self.up[: len(x)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of x[start:end] for each pair; equal ranges have equal hashes wherever they stand."""
        return (sums[end] - sums[start]) * self.down[start]


def text_chunks(ids: list, texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Consecutive rows as (their ids, their UTF-8 bytes in one array, offsets of length rows + 1), about ``limit``
    bytes each; a longer text is a chunk of its own. Null texts are empty."""
    raw = texts.cast(pa.large_binary())
    got: list = []
    parts: list[bytes] = []
    size = 0
    for i, t in zip(ids, raw):
        b = t.as_py() or b""
        if got and size + len(b) > limit:
            yield got, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
            got, parts, size = [], [], 0
        got.append(i)
        parts.append(b)
        size += len(b)
    if got:
        yield got, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    pa.default_memory_pool().release_unused()


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers, kinds: np.ndarray = (~SPACE).astype(np.uint8)
                ) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of several texts, and the words' offsets by text. ``kinds`` gives each
    byte's kind; a word is a longest run of one kind, and kind 0 separates words."""
    n, rows = len(data), len(offsets) - 1
    if not n:
        return np.zeros(0, U64), np.zeros(rows + 1, np.int64)
    kind = kinds[data]
    cut = np.ones(n + 1, bool)  # before each byte, and after the last
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    start = np.flatnonzero(cut[:-1] & (kind > 0))
    end = np.flatnonzero(cut[1:] & (kind > 0)) + 1
    sums = powers.running(LOWER[data].astype(U64) + U64(1))
    return mix(powers.ranges(sums, start, end)), np.searchsorted(start, offsets)


_SHINGLE = [U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3),
            U64(0x589965CC75374CC3), U64(0x1D8E4E27C47D124F), U64(0xEB44ACCAB455D165), U64(0x9E6C63D0876A9A35)]


def shingle_sets(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words (at most 8) of each text, and their offsets by text. A
    text of fewer words has all of them as its only shingle; a text without words has none."""
    rows, count = len(offsets) - 1, np.diff(offsets)
    text = np.repeat(np.arange(rows), count)
    n = len(words)
    acc = np.zeros(n, U64)
    left = np.repeat(offsets[1:], count) - np.arange(n)  # words from here to the end of the text
    for j in range(size):
        take = n - j
        if take > 0:
            acc[:take] += np.where(left[:take] > j, words[j:] * _SHINGLE[j], U64(0))
    first = np.arange(n) == np.repeat(offsets[:-1], count)
    use = (left >= size) | first
    acc = mix(acc + np.minimum(left, size).astype(U64))[use]
    text = text[use]
    order = np.lexsort((acc, text))
    acc, text = acc[order], text[order]
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (text[1:] != text[:-1])
    return acc[new], np.searchsorted(text[new], np.arange(rows + 1))


def batches_of(rows: dict[str, np.ndarray | list], schema: pa.Schema, most: int = 100_000) -> Iterable[pa.RecordBatch]:
    """Columns as record batches of at most ``most`` rows."""
    table = pa.table([pa.array(rows[f.name], f.type) for f in schema], schema=schema)
    return table.to_batches(max_chunksize=most)


def labelled_sample(labels: DataFrame, column: str, most: int) -> DataFrame:
    """Labelled documents, ``most`` at most: (id, label), one row an id, the larger label of two. Of more than ``most`` those
    whose hash is below a cut stay, which aims five standard deviations under ``most``: no sort, and no task meets them
    all. Rows without id or label are left out. The bound makes it small enough to broadcast."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(column).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    n = known.count()
    if n <= most:
        return known
    return known.where(F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53) < (most - 5 * most**0.5) / n)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def components(spark: SparkSession, edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (u, v): one row (node, label) per node that has an edge, label the smallest
    node reachable. Each round hooks every node to the smallest label around it and then jumps to that label's own
    label, so that long chains shrink fast; a hub's many edges meet in a partial minimum before the shuffle. Runs until
    nothing changes; each round is a written table."""
    e = edges.select("u", "v").where("u <> v")
    e = kept_table(spark, e.union(e.select("v", "u")).distinct(), f"{name}-edges")
    labels = kept_table(spark, e.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("label")), name)
    while True:
        near = (e.join(labels, e.v == labels.node).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("to"), F.col("label").alias("above"))
        step = hooked.join(up, "to", "left").select(
            "node", F.least("to", "above").alias("label"), "was")
        step = kept_table(spark, step, name)
        labels = step.select("node", "label")
        if step.where("label <> was").limit(1).count() == 0:
            return labels
