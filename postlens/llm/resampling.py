"""Operator 9, quality by importance resampling.

Two generative models over hashed n-grams (single tokens and pairs; tokens are lower-cased runs of letters and digits,
and runs of marks): one of the target text, the labelled good documents, and one of the raw text, all documents. A
document's log weight is the sum over its n-grams of log(target probability / raw probability). The k documents of the
largest log weight plus Gumbel noise are kept, which samples k documents without replacement in proportion to the
weights. The noise comes from a hash of the row, so a lost task draws the same again.

The raw model counts every document in a pass of its own. The target model counts the documents labelled 1, by default up to
about ``TARGETS`` of them, those of the smallest hashes: their ids are small enough to be broadcast to the scan, so no text
is shuffled and the plan is one and the same at every size. Counts are summed by bucket inside the tasks.

The k-th largest key is found by counting: each pass counts the keys in ``CELLS`` cells of the range still open, and only
these counts reach the driver. Broadcast are one number for each bucket and the target ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import ALNUM_MARKS, U64, Powers, batches_of, kept_table, mix, text_chunks, word_hashes

BITS = 16
BUCKETS = 1 << BITS
CELLS = 4096
#: Labelled good documents that the target model is fitted on, at most (about 10 MB of ids).
TARGETS = 500_000


def _buckets(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the texts' tokens and pairs of tokens, and the text that each belongs to."""
    words, at = word_hashes(data, offsets, powers, ALNUM_MARKS)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    pairs = mix(words[:-1] * U64(0xA0761D6478BD642F) + words[1:])
    same = owner[:-1] == owner[1:]
    grams = np.concatenate([words, pairs[same]]) >> U64(64 - BITS)
    return grams.astype(np.int64), np.concatenate([owner, owner[:-1][same]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
    powers, n = Powers(), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, data, offsets in text_chunks([None] * batch.num_rows, batch.column("text")):
            grams, _ = _buckets(data, offsets, powers)
            n += np.bincount(grams, minlength=BUCKETS)
    some = np.flatnonzero(n)
    yield from batches_of({"bucket": some, "n": n[some]}, schema)


def n_gram_counts(texts: DataFrame) -> np.ndarray:
    """How many n-grams of all ``texts`` (text) fall into each bucket."""
    counts = texts.mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    return out


def target_ids(known: DataFrame, good: int, most: int) -> DataFrame:
    """The ids labelled 1 in ``known`` (id, label), ``good`` in number; of more than ``most`` about that many, those whose hash
    lies under a cut."""
    ids = known.where("label = 1").select("id")
    if good <= most:
        return ids
    return ids.where(F.shiftrightunsigned(F.xxhash64("id"), 1) < int((1 << 63) * (most / good)))


def _weigh(model):
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n_grams", pa.int64()), ("log_weight", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, ratio = Powers(), model.value
        for batch in batches:
            ids = list(zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()))
            for rows, data, offsets in text_chunks(ids, batch.column("text")):
                grams, owner = _buckets(data, offsets, powers)
                # whole numbers: sums don't depend on their order
                n = np.bincount(owner, minlength=len(rows))
                total = np.bincount(owner, weights=ratio[grams], minlength=len(rows))
                yield from batches_of({"doc_id": [r[0] for r in rows], "tie": [r[1] for r in rows], "n_grams": n,
                                       "log_weight": total / 2**20}, schema)

    return run


def kth_largest(df: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest of a finite double column; None if there are not as many rows."""
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if k < 1 or n < k:
        return None
    while low < high:
        step = (high - low) / CELLS
        if not (low + step > low and high - step < high):
            values = sorted(r[0] for r in df.where(F.col(key).between(low, high)).select(key).distinct().collect())
            above = df.where(F.col(key) > high).count()
            counts = dict(df.where(F.col(key).between(low, high)).groupBy(key).count().collect())
            for v in reversed(values):
                above += counts[v]
                if above >= k:
                    return v
        cell = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(step)), F.lit(CELLS - 1))
        counts = dict(df.where(F.col(key).between(low, high)).groupBy(cell.alias("c")).count().collect())
        above = df.where(F.col(key) > high).count()
        for c in sorted(counts, reverse=True):
            if above + counts[c] >= k:
                inside = df.where(F.col(key).between(low, high) & (cell == c)).agg(F.min(key), F.max(key)).first()
                low, high = inside
                break
            above += counts[c]
    return low


def _gumbel(*seed: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(*seed), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def importance_resample(spark: SparkSession, docs: DataFrame, labels: DataFrame, share: float | None = None,
                        targets: int = TARGETS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, tie, n_grams, log_weight, key (log weight plus noise), kept.

    ``labels`` (doc_id, quality): the target are the documents labelled 1. ``share`` of all rows is kept (rounded up);
    by default the share of 1 among all labels. The target model is fitted on about ``targets`` of the good documents at most. Of equal keys at the limit those of smaller doc_id are kept. Null labels
    and labels without id don't count; without any label everything is kept at weight 0. A null or empty text has no
    n-grams and weight 0. Rows of equal doc_id and text get equal weights and equal noise, and are kept or left out
    together, so then some more rows than asked may be kept. Other columns are ignored."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label"))
    known = kept_table(spark, known.dropna().groupBy("id").agg(F.max("label").alias("label")), "quality")
    good, n = known.agg(F.sum("label"), F.count("*")).first()
    if share is None:
        share = good / n if n else 1.0
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie"), "text")
    ids = F.broadcast(target_ids(known, good or 0, targets))  # at most about ``targets`` rows
    raw = 1.0 + n_gram_counts(base.select("text"))
    target = 1.0 + n_gram_counts(base.join(ids, base.doc_id == ids.id, "left_semi").select("text"))
    ratio = np.round((np.log(target / target.sum()) - np.log(raw / raw.sum())) * 2**20) if good else np.zeros(BUCKETS)
    model = spark.sparkContext.broadcast(ratio)
    weighed = base.mapInArrow(_weigh(model), "doc_id long, tie long, n_grams long, log_weight double")
    weighed = weighed.withColumn("key", F.col("log_weight") + _gumbel(F.col("doc_id"), F.col("tie")))
    weighed = kept_table(spark, weighed, "weighed")
    total = weighed.count()
    k = min(total, int(np.ceil(share * total)))
    limit = kth_largest(weighed, "key", k)
    if limit is None:
        return weighed.withColumn("kept", F.lit(total <= k))
    missing = k - weighed.where(F.col("key") > limit).count()
    level = weighed.where(F.col("key") == limit).select("doc_id", "tie").distinct().orderBy("doc_id", "tie").limit(missing)
    level = level.select(F.col("doc_id").alias("d"), F.col("tie").alias("t"), F.lit(True).alias("in"))
    out = weighed.join(level, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")) & (F.col("key") == limit), "left")
    return out.select("doc_id", "tie", "n_grams", "log_weight", "key", ((F.col("key") > limit) | F.coalesce("in", F.lit(False))).alias("kept"))
