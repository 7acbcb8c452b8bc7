"""Operator 12, periodic runs of words by scale-tiled distribution.

A run of period q is a stretch of words equal to those q later, that no neighbouring word extends, whose smallest period is q
and whose length is at least ``max(shortest, 3 * q)``.

Tiles: periods are split into octaves P <= q < 2P. For an octave a document's words are cut into tiles of
``max(TILE, 16 * P)`` words, each starting half a tile after the last; octaves of equal tiles share them. A document of at
most TILE words is one tile, solved by the task that read it; the tiles of longer ones are exploded into rows and dealt to
all tasks.

In a tile boundaries stand at every P-th word. A run of the octave has a boundary c among its first P words, and the words
from c on equal those from c + q on for at least W = max(8, P) words. Window hashes, doubled from octave to octave, give
the lags q at which a boundary has such a long value of its Z-function; all boundaries and lags are looked up at once.
Lags whose block c .. c + q is a repetition of something shorter are no smallest period and go. Neighbouring boundaries that
agree at one lag are one fragment, and the Z-values at its first boundary to the left and at its last to the right, found by
bisecting over ranges' hashes, give its ends.

Fragments that a tile's end may have cut are shuffled with all others by (document, period) and stitched: stretches of
words equal to those q later that touch or overlap are one. Overlapping half tiles hold more than four periods, so every
long run's fragments overlap. What is too short after that goes.

Words are compared by 64-bit hashes. The joins at the end are merge joins at every size; only documents that hold fragments send
their text through one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import SPACE, U64, Powers, batches_of, kept_table, mix, text_chunks

#: Words of a tile of the small octaves, and bytes from which a document is cut into tiles of its own rows.
TILE = 1 << 16
LONG_TEXT = 1 << 18
#: Window that the smallest octaves compare; a run of 24 words or more has one at each of its first boundaries.
WINDOW = 8

_SOLVED = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("collapsed_sha256", pa.string()),
                     ("fragments", pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))),
                     ("text", pa.string())])
_SOLVED_DDL = ("doc_id long, key long, n_words long, collapsed_sha256 string, "
               "fragments array<struct<period:long,first:long,last:long>>, text string")
_TILES = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("cut_left", pa.bool_()),
                    ("cut_right", pa.bool_()), ("words", pa.binary())])
_TILES_DDL = "key long, start long, low long, high long, cut_left boolean, cut_right boolean, words binary"
_FRAGMENTS = pa.schema([("key", pa.int64()), ("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_FRAGMENTS_DDL = "key long, period long, first long, last long"
_RUNS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                   ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_RUNS_DDL = ("doc_id long, key long, n_runs long, start long, length long, period long, exponent_milli long, "
             "runs_sha256 string, collapsed_sha256 string")


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) if the words i >= a of a document of n words become its words a + (i - a) % p."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def unaltered(doc_id: int | None, n: int) -> None:
    """The other choice of ``alter``: every document's words are its own."""


def _order(alter, doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place, if not each its own."""
    got = alter(doc_id, n)
    if got is None:
        return None
    a, p = got
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _words(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, case and all, and the words' offsets by text."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts, ends = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    first[starts] |= inside[starts]
    last[ends] |= inside[ends]
    at = np.flatnonzero(first)
    sums = powers.running(data.astype(U64) + U64(1))
    return mix(powers.ranges(sums, at, np.flatnonzero(last) + 1)), np.searchsorted(at, offsets)


def _smallest_factors(most: int) -> np.ndarray:
    out = np.arange(most + 1)
    for r in range(2, int(most**0.5) + 1):
        if out[r] == r:
            part = out[r * r::r]
            part[part == np.arange(r * r, most + 1, r)] = r
    return out


def _z_values(powers: Powers, sums: np.ndarray, left: np.ndarray, right: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """Z-values: how many words from ``left`` on equal those from ``right`` on, at most ``most``; with step -1, how many words
    before each."""
    low, high = np.zeros(len(left), np.int64), most.copy()
    while (low < high).any():
        k = (low + high + 1) // 2
        if step > 0:
            same = powers.ranges(sums, left, left + k) == powers.ranges(sums, right, right + k)
        else:
            same = powers.ranges(sums, left - k, left) == powers.ranges(sums, right - k, right)
        low, high = np.where(same, k, low), np.where(same, high, k - 1)
    return low


def tile_fragments(words: np.ndarray, offsets: np.ndarray, powers: Powers, low: int, high: int, shortest: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of the periods ``low`` <= q < ``high`` (both powers of 2) in several tiles, whose hashed words stand one after
    the other: (tile, period, first, last), places counted from the tile's start. A fragment is a longest stretch first .. last
    - 1 of the tile whose words equal those q later; it has at least the shorter of ``shortest`` - 2q words and W."""
    found = []
    length = np.diff(offsets)
    sums = powers.running(words)
    end = np.repeat(offsets[1:], length)
    size, hashes = 1, words
    factors = _smallest_factors(2)
    P = 1
    while P < high and len(words) and max(shortest, 3 * P) <= length.max():
        W = max(WINDOW, P)
        while size < W:  # hash of twice the words from the hashes of the two halves; past the tile's end it stands for nothing
            hashes = mix(hashes[: len(hashes) - size] * U64(0xA0761D6478BD642F) + hashes[size:])
            size *= 2
        if P >= low:
            # places x whose own window and that of the boundary before the last one agree: lag x - c lies in the octave
            owner = np.flatnonzero(length >= max(shortest, 3 * P))
            x = np.concatenate([np.arange(offsets[t] + P, offsets[t + 1] - W + 1) for t in owner]) if len(owner) else np.zeros(0, int)
            start = np.repeat(offsets[:-1][owner], np.maximum(length[owner] - P - W + 1, 0))
            c = start + ((x - start) // P - 1) * P
            same = hashes[x] == hashes[c]
            x, c, start = x[same], c[same], start[same]
            q = x - c
            if len(q):
                if len(factors) <= 2 * P:
                    factors = _smallest_factors(4 * P)
                whole, left = np.ones(len(q), bool), q.copy()
                while (left > 1).any():
                    r = factors[left]
                    d = np.where(left > 1, q // np.maximum(r, 1), q)
                    repeats = powers.ranges(sums, c, c + q - d) == powers.ranges(sums, c + d, c + q)
                    whole &= ~(repeats & (left > 1))
                    left = np.where(left > 1, left // np.maximum(r, 1), left)
                c, q, start = c[whole], q[whole], start[whole]
            if len(q):
                order = np.lexsort((c, q, start))
                c, q, start = c[order], q[order], start[order]
                new = np.ones(len(c), bool)
                new[1:] = (q[1:] != q[:-1]) | (start[1:] != start[:-1]) | (c[1:] > c[:-1] + W)
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(c)) - 1
                q, start, a, b = q[head], start[head], c[head], c[tail] + W
                a -= _z_values(powers, sums, a, a + q, a - start, -1)
                b += _z_values(powers, sums, b, b + q, end[start] - b - q, 1)
                found.append((np.searchsorted(offsets, start, side="right") - 1, q, a - start, b - start))
        P *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(part) for part in zip(*found))


def _octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """(lowest period, end of the periods, tile size) for a document of n words; octaves of equal tiles come together."""
    low, P = 1, 1
    while 3 * P <= n:
        size = min(max(TILE, 16 * P), n)
        if 6 * P > n or min(max(TILE, 32 * P), n) != size:
            yield low, 2 * P, size
            low = 2 * P
        P *= 2


def tiles(n: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, lowest period, end of the periods) of all tiles of a document of n words."""
    for low, high, size in _octaves(n):
        start = 0
        while True:
            yield start, min(start + size, n), low, high
            if start + size >= n:
                break
            start += size // 2


def _collapsed(text: bytes, order: np.ndarray | None, dropped: np.ndarray | None) -> str:
    words = text.split()  # bytes are split at ASCII white space
    if order is not None:
        words = [words[i] for i in order]
    if dropped is not None:
        words = [words[i] for i in np.flatnonzero(~dropped)]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _solve_short(alter, shortest: int):
    """Documents of one tile: their fragments, or, without any, what is left of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()))
            for ids, data, offsets in text_chunks(rows, batch.column("text")):
                words, at = _words(data, offsets, powers)
                orders = [_order(alter, d, int(n)) for (d, _), n in zip(ids, np.diff(at))]
                for i, order in enumerate(orders):
                    if order is not None:
                        words[at[i]:at[i + 1]] = words[at[i]:at[i + 1]][order]
                tile, q, first, last = tile_fragments(words, at, powers, 1, 2 * TILE, shortest)
                good = last - first + q >= np.maximum(shortest, 3 * q)
                tile, q, first, last = tile[good], q[good], first[good], last[good]
                by = np.argsort(tile, kind="stable")
                cut = np.searchsorted(tile[by], np.arange(len(ids) + 1))
                out = {n: [] for n in _SOLVED.names}
                for i, (doc_id, key) in enumerate(ids):
                    text = data[offsets[i]:offsets[i + 1]].tobytes()
                    mine = by[cut[i]:cut[i + 1]]
                    out["doc_id"].append(doc_id)
                    out["key"].append(key)
                    out["n_words"].append(at[i + 1] - at[i])
                    out["fragments"].append([{"period": q[j], "first": first[j], "last": last[j]} for j in mine])
                    out["text"].append(text.decode() if len(mine) else None)
                    out["collapsed_sha256"].append(None if len(mine) else _collapsed(text, orders[i], None))
                yield from batches_of(out, _SOLVED)

    return run


def _explode(alter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()))
            for ids, data, offsets in text_chunks(rows, batch.column("text")):
                words, at = _words(data, offsets, powers)
                for i, (doc_id, key) in enumerate(ids):
                    own = words[at[i]:at[i + 1]]
                    n = len(own)
                    order = _order(alter, doc_id, n)
                    own = own if order is None else own[order]
                    for start, end, low, high in tiles(n):
                        yield pa.record_batch([pa.array([v], f.type) for v, f in zip(
                            (key, start, low, high, start > 0, end < n, own[start:end].tobytes()), _TILES)], schema=_TILES)

    return run


def _solve_tiles(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for i in range(batch.num_rows):
                key, start, low, high, cut_left, cut_right, raw = (batch.column(n)[i].as_py() for n in _TILES.names)
                words = np.frombuffer(raw, U64)
                n = len(words)
                _, q, first, last = tile_fragments(words, np.array([0, n]), powers, low, high, shortest)
                good = last - first + q >= np.maximum(shortest, 3 * q)
                good |= (first == 0) & cut_left | (last + q == n) & cut_right
                q, first, last = q[good], first[good] + start, last[good] + start
                yield from batches_of({"key": np.full(len(q), key), "period": q, "first": first, "last": last}, _FRAGMENTS)

    return run


def _describe(alter):
    """Each document's runs as one row: their number, the best one, and what is left without the repetitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n: [] for n in _RUNS.names}
            for i in range(batch.num_rows):
                doc_id, key = batch.column("doc_id")[i].as_py(), batch.column("key")[i].as_py()
                text, n = batch.column("text")[i].as_py().encode(), batch.column("n_words")[i].as_py()
                found = sorted((r["start"], r["length"], r["period"]) for r in batch.column("runs")[i].as_py() or [])
                found.sort(key=lambda r: (r[0], r[2]))
                n = n if n is not None else len(text.split())
                change = np.zeros(n + 1, np.int64)
                for start, length, q in found:
                    change[start + q] += 1
                    change[start + length] -= 1
                start, length, q = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
                values = (doc_id, key, len(found), start, length, q, 1000 * length // q if found else None,
                          hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest(),
                          _collapsed(text, _order(alter, doc_id, n), np.cumsum(change)[:n] > 0 if found else None))
                for name, v in zip(_RUNS.names, values):
                    out[name].append(v)
            yield from batches_of(out, _RUNS)

    return run


def stitched(fragments: DataFrame, shortest: int) -> DataFrame:
    """Runs (key, start, length, period) from fragments (key, period, first, last): those of one document and period that
    touch or overlap are one."""
    w = Window.partitionBy("key", "period").orderBy("first", "last")
    before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    isle = fragments.distinct().withColumn("new", F.when(F.col("first") <= before, 0).otherwise(1))
    isle = isle.withColumn("isle", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = isle.groupBy("key", "period", "isle").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    runs = runs.select("key", "start", (F.col("last") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(shortest), 3 * F.col("period")))


def periodic_runs(spark: SparkSession, docs: DataFrame, shortest: int = 24, alter=unaltered) -> tuple[DataFrame, DataFrame]:
    """(described, runs) of ``docs`` (doc_id, text).

    ``described`` has one row per row of ``docs``: doc_id, key (hash of doc_id and text), n_runs; start, length, period and
    exponent_milli of the run of greatest length / period (ties: smallest start, then period; null without runs);
    runs_sha256 of the lines ``start,length,period`` of all runs by start and period; collapsed_sha256 of the words, joined by
    one space, that no run holds after its first period. ``runs`` has a row per run: key, start, length, period.

    ``shortest`` is at least 24. ``alter`` (doc_id, number of words) gives (a, p) to repeat a document's words from a on
    with period p, or None. Null and empty texts have no words and no runs. Rows of equal doc_id and text get equal results;
    a null doc_id is one like any other and never altered. An empty table gives no rows. Other columns are ignored. A text
    of any length is read whole by the task that has its row, which holds some 60 bytes a word of it."""
    if shortest < 3 * WINDOW:
        raise ValueError(f"the shortest run has at least {3 * WINDOW} words")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.octet_length("text") > LONG_TEXT
    short = base.where(~is_long).mapInArrow(_solve_short(alter, shortest), _SOLVED_DDL)
    long = base.where(is_long)
    solved = kept_table(spark, short.unionByName(long.select(
        "doc_id", "key", "text", F.lit(None).cast("long").alias("n_words"), F.lit(None).cast("string").alias("collapsed_sha256"),
        F.lit(None).cast(_SOLVED_DDL.rsplit("fragments ", 1)[1].rsplit(", text", 1)[0]).alias("fragments"))), "solved")
    dealt = long.dropDuplicates(["key"]).mapInArrow(_explode(alter), _TILES_DDL).repartition(F.xxhash64("key", "start", "low"))
    pieces = dealt.mapInArrow(_solve_tiles(shortest), _FRAGMENTS_DDL).unionByName(
        solved.where(F.size("fragments") > 0).select("key", F.explode("fragments").alias("f")).select("key", "f.*"))
    runs = kept_table(spark, stitched(pieces, shortest), "runs")

    per_doc = runs.groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    texts = solved.where("text IS NOT NULL").select("doc_id", "key", "n_words", "text").dropDuplicates(["key"])
    told = texts.join(per_doc.hint("merge"), "key", "left").mapInArrow(_describe(alter), _RUNS_DDL)
    rest = solved.select("doc_id", "key", F.col("collapsed_sha256").alias("own"))
    out = rest.join(told.drop("doc_id").hint("merge"), "key", "left").select(
        "doc_id", "key", F.coalesce("n_runs", F.lit(0).cast("long")).alias("n_runs"), "start", "length", "period", "exponent_milli",
        F.coalesce("runs_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("runs_sha256"),
        F.coalesce("collapsed_sha256", "own").alias("collapsed_sha256"))
    return out, runs
