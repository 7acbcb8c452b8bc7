"""Operator 7, suffix-array dedup: every byte inside a ``threshold``-byte string that also starts earlier is removed.

Distributed prefix doubling, made sparse. A plain round would sort every position with its rank; here the ranks of the
first lengths (1, 2, 4, 8 bytes, then 24) are made inside the tasks, by pairing the rank at a position with the rank at
the next offset (ranks are 64-bit names, equal exactly for equal strings but for hash collisions), and Spark sorts only:

* round 1: one position per run of window starts whose smallest 24-byte rank is the same occurrence (about one in 39).
  Equal windows always choose the same occurrence, so a window whose chosen rank is unique in the corpus is unique;
* round 2: what is left, in blocks of ``BLOCK`` window starts, by the rank of the string that the block's windows share;
* round 3: what is left, position by position, by the rank of the whole ``threshold`` bytes.

In each round the rows are sorted by (rank, rank of the whole span, document, start): a span whose equal starts earlier
is removed whole, a span whose rank is unique is dropped, the rest goes on. Rows that a task can decide alone (an equal
span seen earlier in the same batch; more than two different spans of one rank) never meet at the rank's own place, so
one very common passage costs each rank at most two rows a batch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import U64, Powers, batches_of, kept_table, mix, signed

GRAM = 24
BLOCK = 9
#: Rows that a task gathers before it compares them with each other.
HOLD = 300_000
DECIDED, ONWARD = 1, 2

_ROWS = pa.schema([("key", pa.int64()), ("full", pa.int64()), ("d", pa.int64()), ("place", pa.int64()),
                   ("kind", pa.int8()), ("off", pa.int16()), ("width", pa.int16())])
_ROWS_DDL = "key long, full long, d long, place long, kind byte, off short, width short"
_C = [U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)]


def gram_ranks(data: np.ndarray) -> np.ndarray:
    """Names of the GRAM-byte strings at each position, by doubling: 1, 2, 4, 8 bytes, then three eights."""
    r = data.astype(U64)
    for h in (1, 2, 4):
        r = r[:-h] | (r[h:] << U64(8 * h))
    n = len(data) - GRAM + 1
    x = r[:n] * _C[0] + r[8 : 8 + n] * _C[1] + r[16 : 16 + n] * _C[2]
    x ^= x >> U64(32)
    x *= U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(29)
    return x


def smallest_in_windows(ranks: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` positions the place of its smallest rank, leftmost at ties."""
    bits = U64(max(20, len(ranks).bit_length()))
    m = (ranks >> bits << bits) | np.arange(len(ranks), dtype=U64)
    have = 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: have - width], m[width - have :])
    return (m & ((U64(1) << bits) - U64(1))).astype(np.int64)


class _Sums:
    def __init__(self) -> None:
        self.powers = Powers()

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ranks = gram_ranks(data)
        return ranks, self.powers.running(ranks)

    def name(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Names of the byte ranges [start, end), each of GRAM bytes or more."""
        return mix(self.powers.ranges(sums, start, end - (GRAM - 1)))


def _runs(data: np.ndarray, sums: _Sums, threshold: int) -> dict[str, np.ndarray]:
    """Round 1: runs of window starts with the same smallest rank."""
    ranks, s = sums.of(data)
    at = smallest_in_windows(ranks, threshold - GRAM + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    width = np.diff(np.r_[first, len(at)])
    anchor = at[first]
    full = sums.name(s, first, first + width + (threshold - 1))
    return {"key": ranks[anchor], "full": mix(full + ((anchor - first) * 128 + width).astype(U64)), "start": first,
            "off": anchor - first, "width": width}


def _blocks(data: np.ndarray, sums: _Sums, threshold: int, spans: np.ndarray) -> dict[str, np.ndarray]:
    """Round 2: each run in blocks, laid out from its anchor so that equal windows fall into equal blocks."""
    _, s = sums.of(data)
    start, off, width = spans >> 16, spans >> 8 & 255, spans & 255
    lo, hi = off - width + 1, off
    count = hi // BLOCK - lo // BLOCK + 1
    which = np.repeat(np.arange(len(spans)), count)
    j = (lo // BLOCK)[which] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    anchor = (start + off)[which]
    o1, o2 = np.maximum(lo[which], j * BLOCK), np.minimum(hi[which], j * BLOCK + BLOCK - 1)
    first, w = anchor - o2, o2 - o1 + 1
    key = sums.name(s, anchor - j * BLOCK, anchor - j * BLOCK - (BLOCK - 1) + threshold)
    full = sums.name(s, first, first + w + (threshold - 1))
    return {"key": key, "full": mix(full + ((o2 - j * BLOCK) * 128 + w).astype(U64)), "start": first,
            "off": np.zeros(len(first), np.int64), "width": w}


def _windows(data: np.ndarray, sums: _Sums, threshold: int, spans: np.ndarray) -> dict[str, np.ndarray]:
    """Round 3: every window start that is left."""
    _, s = sums.of(data)
    start, width = spans >> 16, spans & 255
    first = np.repeat(start, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    return {"key": sums.name(s, first, first + threshold), "full": sums.name(s, first, first + threshold // 2),
            "start": first, "off": np.zeros(len(first), np.int64), "width": np.ones(len(first), np.int64)}


def _decide(rows: dict[str, np.ndarray], onward: bool) -> dict[str, np.ndarray]:
    """What this batch alone can tell. Decided rows get a key of their own, so they don't meet at the rank's place."""
    key, full, d, place = rows["key"], rows["full"], rows["d"], rows["place"]
    order = np.lexsort((place, d, full, key))
    k, f = key[order], full[order]
    new_key = np.r_[True, k[1:] != k[:-1]]
    new = new_key | np.r_[True, f[1:] != f[:-1]]
    kind = np.zeros(len(key), np.int8)
    kind[order[~new]] = DECIDED
    if onward:  # of one key's different spans the smallest and the largest name stay; they tell the others elsewhere
        last = np.r_[new_key[1:], True]  # last row of its key; its span's first row may stand before it
        span = np.cumsum(new) - 1
        lasting = np.zeros(span[-1] + 1 if len(span) else 0, bool)
        lasting[span[last]] = True
        kind[order[new & ~new_key & ~lasting[span]]] = ONWARD
    moved = kind != 0
    key = np.where(moved, mix(place.astype(U64) * _C[0] + d.astype(U64)), key)
    return rows | {"key": signed(key), "full": signed(np.where(moved, U64(0), full)), "kind": kind}


def _emit(found: list[dict[str, np.ndarray]], onward: bool) -> Iterator[pa.RecordBatch]:
    if found:
        rows = {c: np.concatenate([x[c] for x in found]) for c in found[0]}
        yield from batches_of(_decide(rows, onward), _ROWS)


def _round(threshold: int, level: int):
    """mapInArrow function of a round: (d, text) or (d, text, spans) to rows."""
    make = (_runs, _blocks, _windows)[level - 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, found, held = _Sums(), [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            lists = batch.column("spans") if level > 1 else None
            for i, d in enumerate(batch.column("d").to_pylist()):
                raw = texts[i].as_py() or b""
                if len(raw) < threshold:
                    continue
                more = () if lists is None else (lists[i].values.to_numpy(zero_copy_only=False),)
                rows = make(np.frombuffer(raw, np.uint8), sums, threshold, *more)
                start = rows.pop("start")
                rows["place"] = (zlib.crc32(raw) << 31) + start
                rows["d"] = np.full(len(start), d, np.int64)
                found.append(rows)
                held += len(start)
                if held >= HOLD:
                    yield from _emit(found, level < 3)
                    found, held = [], 0
        yield from _emit(found, level < 3)

    return run


def _rerank(rows: DataFrame, level: int) -> DataFrame:
    """Sort by rank; what is decided (kind 1) and what goes on (kind 2)."""
    by = Window.partitionBy("key")
    before = F.lag("full").over(by.orderBy("full", "d", "place"))
    rows = rows.withColumn("again", before.isNotNull() & (before == F.col("full")))
    if level < 3:
        rows = rows.withColumn("several", F.min("full").over(by) < F.max("full").over(by))
    else:
        rows = rows.withColumn("several", F.lit(False))
    kind = (F.when(F.col("kind") != 0, F.col("kind")).when(F.col("again"), F.lit(DECIDED).cast("byte"))
            .when(F.col("several"), F.lit(ONWARD).cast("byte")))
    return rows.withColumn("kind", kind).where("kind IS NOT NULL").select("kind", "d", "place", "off", "width")


def _by_document(rows: DataFrame) -> DataFrame:
    """The spans of each document in one array: start, offset and width in one number."""
    start = F.col("place").bitwiseAND(F.lit((1 << 31) - 1))
    span = F.shiftleft(start, 16) + F.shiftleft(F.col("off").cast("long"), 8) + F.col("width")
    return rows.groupBy("d", F.shiftright("place", 31).alias("tie")).agg(F.collect_list(span).alias("spans"))


def _remove(threshold: int, columns: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")}
            lists = batch.column("__spans")
            for t, spans in zip(batch.column("__text").cast(pa.large_binary()), lists):
                raw = t.as_py() or b""
                removed = runs = 0
                kept = raw
                if spans.is_valid:
                    x = spans.values.to_numpy(zero_copy_only=False)
                    cover = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(cover, x >> 16, 1)
                    np.add.at(cover, (x >> 16) + (x & 255) + (threshold - 1), -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    removed = int(gone.sum())
                    runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(removed)
                out["n_spans"].append(runs)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(kept.decode("utf-8", "ignore") if t.is_valid else None)
            got = {c: batch.column(c) for c in columns} | out
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) if f.name in out else got[f.name].cast(f.type)
                                              for f in schema], schema=schema)

    return run


def _once(spark: SparkSession, work: DataFrame) -> DataFrame:
    """``work`` (d, tie, text) with rows of equal d and text once; only repeated rows are shuffled with their texts."""
    again = work.where("tie IS NOT NULL").groupBy("d", "tie").agg(F.count("*").alias("n")).where("n > 1").select("d", "tie")
    again = kept_table(spark, again, "repeated")
    if again.limit(1).count() == 0:
        return work
    some = kept_table(spark, work.join(again, ["d", "tie"], "left_semi").distinct(), "once")
    return work.join(again, ["d", "tie"], "left_anti").unionByName(some)


def suffix_dedup(spark: SparkSession, docs: DataFrame, threshold: int = 100) -> DataFrame:
    """``docs`` (doc_id, text, more columns) with n_bytes, n_removed, n_spans, kept_sha256 and kept_text.

    A byte is removed if some ``threshold``-byte string that covers it also starts earlier: in a document of smaller
    doc_id, or earlier in the same document (overlaps count). Strings are judged on the input, and never cross
    documents. kept_text are the remaining bytes as UTF-8; parts of a character that was cut are left out.

    Null or empty text: nothing to remove (n_bytes 0; kept_text null or empty). A null doc_id counts as smaller than
    any other. Different texts of one doc_id stand in the order of their CRC-32; rows of equal doc_id and text count as
    one document and get equal results. Columns of these names in the input are replaced. ``threshold``: 64 to 127.
    """
    if not 64 <= threshold <= 127:
        raise ValueError("threshold must be from 64 to 127 bytes")
    own = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    names = [c for c in docs.columns if c not in own]
    work = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.crc32(F.col("text").cast("binary")).alias("tie"), "text")
    work = _once(spark, work)
    rows = work.select("d", "text").mapInArrow(_round(threshold, 1), _ROWS_DDL)
    runs = kept_table(spark, _rerank(rows, 1), "runs")
    decided = [runs.where(F.col("kind") == DECIDED)]
    left = runs
    for level in (2, 3):
        rows = work.join(_by_document(left.where(F.col("kind") == ONWARD)), ["d", "tie"]).select("d", "text", "spans")
        ranked = _rerank(rows.mapInArrow(_round(threshold, level), _ROWS_DDL), level)
        left = kept_table(spark, ranked, "spans")
        decided.append(left.where(F.col("kind") == DECIDED))
    spans = _by_document(decided[0].unionByName(decided[1]).unionByName(decided[2]))
    whole = docs.select(*names, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("__d"),
                        F.crc32(F.col("text").cast("binary")).alias("__tie"), F.col("text").alias("__text"))
    whole = whole.join(spans.select(F.col("d").alias("__d"), F.col("tie").alias("__tie"), F.col("spans").alias("__spans")),
                       ["__d", "__tie"], "left").select(*names, "__text", "__spans")
    schema = docs.select(*names).limit(0).withColumns({
        "n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"),
        "kept_sha256": F.lit(""), "kept_text": F.lit(None).cast("string")}).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return whole.mapInArrow(_remove(threshold, names, arrow), schema)
