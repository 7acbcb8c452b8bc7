"""Operator 10, toxicity by maximum-scoring segments of token log-odds.

Model: words (lower-cased runs of letters, digits and bytes beyond ASCII) are hashed into ``BUCKETS`` buckets; a bucket
counts once in each toxic or clean training document that has it. Its log-odds ratio under a Dirichlet prior (half a
document, and ``PRIOR`` documents shaped like all of them) is drawn towards 0 by ``SHRINK`` standard deviations, so rare
words weigh nothing. ``DRIFT`` is taken from every word, which makes long clean stretches negative.

Scan: all maximal scoring segments of a text, in linear time. A segment's score S turns into an expected number of such
segments in a clean text of n words, E = K n exp(-lambda S); lambda comes from the clean words' score distribution, K
from the best segments of the clean training documents. Segments of E below ``EXPECTED`` are reported as passages. The
number of segments that score S or more is about Poisson, so r of them have a probability of about E(S)^r / r!; a text's
evidence is the largest -ln of that over its r best segments, r = 1, 2, ... A logistic curve fitted on the training
documents makes it a probability.

Of training documents of one label whose sketches of three coordinates agree, as those of copies mostly do, only one is
learnt from: a copied text would make all its words look telling.

Bounds: the training documents are at most ``TRAINING`` labelled rows (smallest hashes); only the model (BUCKETS numbers)
and a histogram of BINS cells reach the driver and are broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import ALNUM, U64, Powers, batches_of, kept_table, labelled_sample, mix, shingle_sets, signed, text_chunks, word_hashes

TRAINING = 100_000
BITS = 18
BUCKETS = 1 << BITS
PRIOR, SHRINK, DRIFT, EXPECTED = 1.0, 2.5, 1.0, 0.01
BINS, LOW, HIGH = 400, -20.0, 60.0


def held_out(doc_id: Column) -> Column:
    """CRC-32 of the id's decimal text is divisible by 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())])
    powers, seen = Powers(), np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for labels, data, offsets in text_chunks(batch.column("label").to_pylist(), batch.column("text")):
            words, at = word_hashes(data, offsets, powers, ALNUM)
            bucket = (words >> U64(64 - BITS)).astype(np.int64)
            owner = np.repeat(np.arange(len(labels)), np.diff(at))
            once = np.unique(owner * BUCKETS + bucket)
            toxic = np.array(labels, np.int64)[once >> BITS]
            seen += np.bincount(toxic * BUCKETS + (once & (BUCKETS - 1)), minlength=2 * BUCKETS).reshape(2, BUCKETS)
    some = np.flatnonzero(seen.any(axis=0))
    yield from batches_of({"bucket": some, "clean": seen[0][some], "toxic": seen[1][some]}, schema)


def _signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of three hashes of the pairs of neighbouring words, the smallest values together: alike for most copies of a
    text, and hardly ever for texts that only share common words."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("signature", pa.int64())])
    powers = Powers()
    for batch in batches:
        rows = list(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist()))
        for ids, data, offsets in text_chunks(rows, batch.column("text")):
            sets, at = shingle_sets(*word_hashes(data, offsets, powers, ALNUM), 2)
            least, full = np.zeros(len(ids), U64), np.flatnonzero(np.diff(at))
            for seed in range(1, 4 if len(full) else 1):
                least[full] = mix(least[full] ^ np.minimum.reduceat(mix(sets ^ U64(seed)), at[full]))
            yield from batches_of({"id": [r[0] for r in ids], "label": [r[1] for r in ids], "signature": signed(least)}, schema)


def token_scores(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Score of each bucket, by the training documents that have it: its shrunk log-odds ratio less the drift. Without
    documents of both kinds all are -DRIFT."""
    if not n_clean or not n_toxic:
        return np.full(len(clean), -DRIFT)
    prior = 0.5 + PRIOR * (clean + toxic) / (n_clean + n_toxic)
    t, c = toxic + prior, clean + prior
    odds = np.log(t / (n_toxic + PRIOR + 1 - t)) - np.log(c / (n_clean + PRIOR + 1 - c))
    spread = SHRINK * np.sqrt(1 / t + 1 / c)
    return np.sign(odds) * np.maximum(0, np.abs(odds) - spread) - DRIFT


def decay(scores: np.ndarray, weights: np.ndarray) -> float:
    """lambda > 0 with sum of p exp(lambda s) = 1 for the clean words' scores; 1 if no positive score is seen."""
    p = weights / max(1, weights.sum())
    if not (p[scores > 0] > 0).any() or (p * scores).sum() >= 0:
        return 1.0
    excess = lambda x: float((p * np.exp(np.minimum(x * scores, 600))).sum()) - 1
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def maximal_segments(at: list[int], before: list[float], after: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), from the places of the positive scores and the running sums
    before and after each. Each candidate keeps the place of the last one before it that starts lower, so a search passes over
    those that don't, and the scan is linear."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, last one that starts lower
    for p, left, right in zip(at, before, after):
        first, j = p, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((first, p, left, right, j))
                break
            first, left = found[j][0], found[j][2]  # joined with that one; what stood between goes
            lower = found[j][4]
            del found[j:]
            j = lower
    return [(a, b, y - x) for a, b, x, y, _ in found]


def _scan(model):
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n_words", pa.int64()), ("best", pa.float64()),
                        ("passages", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, scores = Powers(), model.value
        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()))
            for ids, data, offsets in text_chunks(rows, batch.column("text")):
                words, at = word_hashes(data, offsets, powers, ALNUM)
                s = scores[(words >> U64(64 - BITS)).astype(np.int64)]
                up = np.flatnonzero(s > 0)
                # one running sum for the chunk, rounded: differences inside a text don't depend on its neighbours
                total = np.concatenate([[0], np.cumsum(np.round(s * 2**20).astype(np.int64))])
                cut = np.searchsorted(up, at)
                best, passages = np.zeros(len(ids)), [[] for _ in ids]
                for i in np.flatnonzero(np.diff(cut)):
                    own = up[cut[i] : cut[i + 1]]
                    got = maximal_segments((own - at[i]).tolist(), (total[own] / 2**20).tolist(), (total[own + 1] / 2**20).tolist())
                    best[i] = max(x[2] for x in got)
                    passages[i] = [{"first": a, "last": b, "score": x} for a, b, x in got]
                yield from batches_of({"doc_id": [r[0] for r in ids], "tie": [r[1] for r in ids], "n_words": np.diff(at), "best": best, "passages": passages}, schema)

    return run


def fit_logistic(x: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and intercept of a logistic curve over weighted points, with a weak pull to slope 0."""
    a, b = 0.0, math.log((ones.sum() + 0.5) / (zeros.sum() + 0.5))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        w = (ones + zeros) * p * (1 - p)
        g = ones - (ones + zeros) * p
        ga, gb = (g * x).sum() - 0.01 * a, g.sum()
        haa, hab, hbb = (w * x * x).sum() + 0.01, (w * x).sum(), w.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2 / max(abs(da), abs(db), 1e-9))
        a, b = max(0.0, a + step * da), b + step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, training: int = TRAINING) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, tie (CRC-32 of the text), held_out, score (0 to 1), predicted
    (score >= 0.5), n_words, passages (first word, last word, score of each significant segment).

    ``labels`` (doc_id, toxic): learnt are only documents that are not held out; of two labels of one document the
    larger counts, null ones don't. Documents are joined to labels by doc_id, so each row of a repeated doc_id counts.
    A null or empty text has no words and gets the score of a text without evidence; without labels of both kinds every
    score is the share of toxic labels, drawn to a half. Other columns are ignored."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie"), "text")
    train = labelled_sample(labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)), "toxic", training)
    train = kept_table(spark, train, "toxic-training")
    known = base.join(F.broadcast(train), base.doc_id == train.id).select("id", "label", "text")
    train = known.mapInArrow(_signature, "id long, label int, signature long").groupBy("signature", "label").agg(F.min("id").alias("id"))
    train = kept_table(spark, train.groupBy("id").agg(F.max("label").alias("label")), "toxic-training")
    known = base.join(F.broadcast(train), base.doc_id == train.id).select("label", "text")
    counts = known.mapInArrow(_count, "bucket int, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    clean, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counts.column("bucket").to_numpy()
    clean[at], toxic[at] = counts.column("clean").to_numpy(), counts.column("toxic").to_numpy()
    sizes = dict(known.groupBy("label").count().collect())
    scores = token_scores(clean, toxic, sizes.get(0, 0), sizes.get(1, 0))
    lam = decay(scores, clean)

    scanned = kept_table(spark, base.mapInArrow(
        _scan(spark.sparkContext.broadcast(scores)),
        "doc_id long, tie long, n_words long, best double, passages array<struct<first:int,last:int,score:double>>"), "scanned")
    size = F.log(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    clean_best = scanned.join(train.where("label = 0"), F.col("doc_id") == F.col("id"))
    mean = clean_best.agg(F.avg(F.greatest(F.lit(lam) * F.col("best") - size, F.lit(-30.0)))).first()[0]
    log_k = (mean if mean is not None else 0.0) - 0.5772156649

    def surprise(score: Column, i: Column) -> Column:
        r = (i + 1).cast("double")
        factorial = r * F.log(r) - r + F.log(r * (2 * math.pi)) / 2
        return r * (F.lit(lam) * score - size - F.lit(log_k)) + factorial

    ordered = F.sort_array(F.transform("passages", lambda x: x["score"]), asc=False)
    found = F.coalesce(F.array_max(F.transform(ordered, surprise)), F.lit(LOW))
    scanned = scanned.withColumn("evidence", F.least(F.greatest(found, F.lit(LOW)), F.lit(HIGH)))
    place = F.least(F.floor((F.col("evidence") - LOW) * BINS / (HIGH - LOW)), F.lit(BINS - 1)).cast("int")
    cells = scanned.select("doc_id", place.alias("cell")).join(train, F.col("doc_id") == F.col("id")).groupBy(
        "cell", "label").count().collect()
    seen = np.zeros((2, BINS))
    for r in cells:
        seen[r["label"], r["cell"]] += r["count"]
    middle = LOW + (np.arange(BINS) + 0.5) * (HIGH - LOW) / BINS
    slope, shift = fit_logistic(middle, seen[1], seen[0])

    score = F.round(1 / (1 + F.exp(-(F.lit(slope) * F.col("evidence") + F.lit(shift)))), 9)
    bar = (size + F.lit(log_k - math.log(EXPECTED))) / F.lit(lam)
    return scanned.select("doc_id", "tie", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                          (score >= 0.5).cast("int").alias("predicted"), "n_words",
                          F.filter("passages", lambda x: x["score"] >= bar).alias("passages"))
