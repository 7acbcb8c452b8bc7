"""Operator 13, document fingerprints by locally consistent parsing.

A text's bytes are the symbols of level 0. On each level runs of one symbol become one element, and deterministic coin tossing
gives each element a label out of six: a symbol's label is the place of its lowest bit that differs from the symbol before,
with that bit's value; labels are tossed again until they are under 6, and neighbours always differ. Where a label is larger
than both neighbours' a phrase begins. A phrase's name is a hash of its elements, and the names are the symbols of the
next level, until one name is left. Phrases hold 2 to 12 elements, and where one begins depends on a few elements around it only:
equal substrings get the same names on every level, whatever stands before them, but for a few at either end.

A fingerprint is a sketch of the names from level ``LEVEL`` on (some 27 bytes a phrase; a text that ends below has its last
name): the ``SLOTS`` smallest of their hashes, ten hexadecimal digits each. Likeness of two fingerprints is estimated
from the smallest hashes of both together: twice the common names over the sum of both numbers of names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import U64, Powers, batches_of, kept_table, mix

LEVEL = 3
SLOTS = 64
_BYTES = 5
#: Bytes of text that are parsed at once; a longer text is parsed alone.
CHUNK = 1 << 20

_JUDGED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                     ("part", pa.int32()), ("kind", pa.string()), ("text", pa.string())])
_JUDGED_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, "
               "near_next double, part int, kind string, text string")


def toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5 of symbols that differ from the one before; ``first`` marks the texts' first symbols. Bytes take three
    rounds, 64-bit names four, whatever they are."""
    labels = symbols
    for _ in range(3 if symbols.dtype == np.uint8 else 4):
        differs = labels.copy()
        differs[1:] ^= labels[:-1]
        differs[first] = 1
        place = np.bitwise_count((differs & (~differs + differs.dtype.type(1))) - differs.dtype.type(1))
        labels = (place << 1 | (labels >> place.astype(labels.dtype) & labels.dtype.type(1)).astype(np.uint8)).astype(np.uint8)
    return labels


def next_level(symbols: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of several texts, none empty, and their offsets by text."""
    n = len(symbols)
    new = np.ones(n, bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new[offsets[:-1]] = True
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, n))
    symbols = symbols[at]
    offsets = np.searchsorted(at, offsets)
    first = offsets[:-1]
    labels = toss(symbols, first)
    starts = np.zeros(len(symbols), bool)
    starts[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    starts[offsets[1:] - 1] = False  # a text's last element begins no phrase
    starts[first] = True
    begin = np.flatnonzero(starts)
    sums = powers.running(mix(symbols.astype(U64) ^ mix(length.astype(U64))))
    names = mix(powers.ranges(sums, begin, np.append(begin[1:], len(symbols))))
    return names, np.searchsorted(begin, offsets)


def phrase_names(data: np.ndarray, offsets: np.ndarray, powers: Powers, level: int = LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """Names from ``level`` on of several texts, and the text of each. A text that has one name left before has that one; an
    empty text has none."""
    text = np.flatnonzero(np.diff(offsets))
    symbols, at = data, np.append(offsets[text], len(data))
    names, owners, i = [], [], 0
    while len(text):
        symbols, at = next_level(symbols, at, powers)
        i += 1
        count = np.diff(at)
        use = np.repeat((count == 1) | (i >= level), count)
        names.append(symbols[use])
        owners.append(np.repeat(text, count)[use])
        more = count > 1
        symbols, text = symbols[np.repeat(more, count)], text[more]
        at = np.append(0, np.cumsum(count[more]))
    return (np.concatenate(names), np.concatenate(owners)) if names else (np.zeros(0, U64), np.zeros(0, np.int64))


def fingerprints(texts: list[bytes], powers: Powers) -> list[bytes]:
    """The texts' fingerprints, five bytes a hash; that of an empty text is empty."""
    offsets = np.cumsum([0, *map(len, texts)])
    names, owner = phrase_names(np.frombuffer(b"".join(texts), np.uint8), offsets, powers)
    value = mix(names) >> U64(64 - 8 * _BYTES)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    at = np.searchsorted(owner, np.arange(len(texts) + 1))
    raw = value.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BYTES:]
    return [raw[a:min(b, a + SLOTS)].tobytes() for a, b in zip(at, at[1:])]


def likeness(one: bytes, other: bytes) -> float:
    """Estimated likeness of two fingerprints, 0 to 1; two empty ones are alike, an empty one is like no other."""
    a, b = ({f[i:i + _BYTES] for i in range(0, len(f), _BYTES)} for f in (one, other))
    least = sorted(a | b)[:SLOTS]
    if not least:
        return 1.0
    both = sum(v in a and v in b for v in least) / len(least)
    return 2 * both / (1 + both)


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first code points of ``following``, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _judge(pairs: list[tuple[int | None, str, str]], powers: Powers, part: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows for (doc_id, text, next text)."""
    changed = [edited(t, u).encode() for _, t, u in pairs]
    # a document's next one is mostly the one before it in the list: parsed once
    whole = list(dict.fromkeys(t for _, *both in pairs for t in both))
    own = dict(zip(whole, fingerprints([t.encode() for t in whole], powers)))
    prints = fingerprints(changed, powers)
    yield from batches_of({
        "doc_id": [d for d, _, _ in pairs], "n_chars": [len(t) for _, t, _ in pairs],
        "edited_sha256": [hashlib.sha256(c).hexdigest() for c in changed], "fingerprint": [own[t] for _, t, _ in pairs],
        "edited_fingerprint": prints, "near_edited": [likeness(own[t], p) for (_, t, _), p in zip(pairs, prints)],
        "near_next": [likeness(own[t], own[u]) for _, t, u in pairs],
        "part": [part] * len(pairs), "kind": [kind] * len(pairs), "text": [None] * len(pairs)}, _JUDGED)


def _end(doc_id: int | None, text: str, part: int, kind: str) -> pa.RecordBatch:
    row = dict.fromkeys(_JUDGED.names) | {"doc_id": doc_id, "part": part, "kind": kind, "text": text}
    return pa.RecordBatch.from_pylist([row], _JUDGED)


def _judge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition, each with the one after it; the partition's first and last texts come as rows for the
    partitions beside."""
    powers, part = Powers(), TaskContext.get().partitionId()
    pairs: list = []
    size, last = 0, None
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if last is None:
                yield _end(doc_id, text, part, "first")
            else:
                pairs.append((*last, text))
                size += len(text)
                if size > CHUNK:
                    yield from _judge(pairs, powers, part, "row")
                    pairs, size = [], 0
            last = doc_id, text
    if pairs:
        yield from _judge(pairs, powers, part, "row")
    if last is not None:
        yield _end(*last, part, "last")


def _judge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for doc_id, text, following in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "following"))):
            yield from _judge([(doc_id, text, following)], powers, 0, "row")


def document_fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next: the text's own fingerprint, that of its edited text (its last half replaced by the first half of the
    next document's, by descending doc_id, the first after the last), and how like they are to each other and to the next
    document's.

    Null texts are empty; an empty text's fingerprint is empty. Null ids come last in descending order; rows of one id go by a
    hash of their text, equal rows in any order. A single row is its own next. An empty table gives no rows. Other columns are
    ignored. A text of any length is parsed whole by its row's task, which holds some 60 bytes a byte of it.

    The rows are dealt by range and sorted inside partitions, one shuffle of the texts; only the first and last text of each
    partition go on to a join with their neighbours."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # the last key parts equal rows, so that no partition must take all of them
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").asc(), F.col("place").asc()]
    keyed = base.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    judged = kept_table(spark, dealt.mapInArrow(_judge_sorted, _JUDGED_DDL), "fingerprints")

    firsts = judged.where("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    parts = judged.where("kind = 'first'").select("part")  # one number a partition
    in_order = Window.orderBy("part")
    ring = parts.select("part", F.coalesce(F.lead("part").over(in_order), F.first("part").over(in_order)).alias("next"))
    lasts = judged.where("kind = 'last'").select("doc_id", "text", "part").join(ring.hint("merge"), "part")
    closing = lasts.join(firsts.hint("merge"), "next").select("doc_id", "text", "following").mapInArrow(_judge_pairs, _JUDGED_DDL)
    out = judged.where("kind = 'row'").unionByName(closing).drop("part", "kind", "text")
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
