"""Operator 1, MinHash near-dedup by fast similarity sketching, banding and exact verification.

Sketch: ``BANDS * ROWS`` coordinates. In round i every shingle draws a bin and a value of at least i; in the first
rounds the bin is random, in later ones it is round i's own bin for every shingle, so each coordinate is certainly
filled, most after a few rounds. A coordinate is its smallest value. Two sets agree on a coordinate with the
probability of their Jaccard similarity, and the share of agreeing coordinates is concentrated around it.

Banding: sets that agree on all ROWS coordinates of a band meet in a bucket; at similarity 0.8 a pair misses all 40
bands with probability 5e-6. Equal sets are one node from the start, so copies cost nothing.

Verification counts shared shingles of the full sets. First each node is checked against one node: the smallest of its
buckets' smallest that it meets most often; then each node outside the largest component of a bucket against one node of
that component. Both take one pair a node. Where a bucket still holds more than one component, its nodes outside the
largest one are compared with all others, in blocks dealt to many tasks, each pair in the first bucket that both share:
first by sketch, which leaves out pairs that can't be similar enough, then, for nodes that are left, by full sets, most
alike pairs first, as long as the two are not connected yet. No pairs are emitted, only the links that connect.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import (U64, Powers, batches_of, components, kept_table, mix, shingle_sets, signed,
                                 text_chunks, word_hashes)

BANDS, ROWS = 40, 6
SIZE = BANDS * ROWS
#: Sketches of a pair of the wanted similarity agree on fewer coordinates than this many deviations below it once in a
#: million.
DEVIATIONS = 4.8
#: Members of a bucket that are compared in one block, and partners of one node that are verified in one task.
BLOCK, GROUP = 512, 128
EMPTY = U64(0xFFFFFFFFFFFFFFFF)

_SKETCHED = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
                       ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
_SKETCHED_DDL = "doc_id long, tie long, n_shingles long, node long, bands array<long>, sketch binary"


def sketches(sets: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A row of ``size`` coordinates for each set; sets must not be empty."""
    rows = len(offsets) - 1
    out = np.full((rows, size), EMPTY, U64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    for i in range(2 * size):
        h = mix(sets ^ mix(np.array([i + 1], U64)))
        value = U64(i << 54) | (h & U64((1 << 54) - 1))
        if i < size:
            place = (mix(h) >> U64(32)) * U64(size) >> U64(32)
        else:
            place = np.full(len(sets), i - size, U64)
        np.minimum.at(flat, owner * size + place.astype(np.int64), value)
        open_rows = (out == EMPTY).any(axis=1)
        if not open_rows.any():
            break
        keep = open_rows[owner]
        if not keep.all():
            sets, owner = sets[keep], owner[keep]
    return out


def _sketch_texts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for ids, data, offsets in text_chunks(batch.column("doc_id").to_pylist(), batch.column("text")):
                sets, at = shingle_sets(*word_hashes(data, offsets, powers), size)
                n = np.diff(at)
                raw = data.tobytes()
                ties = [zlib.crc32(raw[a:b]) for a, b in zip(offsets, offsets[1:])]
                full = np.flatnonzero(n > 0)
                names, bands, coords = np.zeros(len(n), U64), [None] * len(n), [None] * len(n)
                if len(full):
                    names[full] = mix(np.add.reduceat(mix(sets), at[full]) ^ n[full].astype(U64))
                    got = sketches(sets, np.r_[at[full], at[-1]])
                    band = np.zeros((len(full), BANDS), U64)
                    for j in range(ROWS):
                        band = mix(band ^ got[:, j::ROWS]) if j else mix(got[:, ::ROWS] + np.arange(BANDS, dtype=U64))
                    low = (mix(got) & U64(255)).astype(np.uint8)
                    for k, i in enumerate(full):
                        bands[i], coords[i] = signed(band[k]), low[k].tobytes()
                yield from batches_of({"doc_id": ids, "tie": ties, "n_shingles": n, "node": signed(names),
                                       "bands": bands, "sketch": coords}, _SKETCHED)

    return run


def _check_pairs(size: int, per_cent: int):
    """Rows sorted by (u, part, member): u's own text (member null), then its partners' texts."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, now, own = Powers(), None, None
        for batch in batches:
            good: list[tuple[int, int]] = []
            heads = list(zip(*(batch.column(c).to_pylist() for c in ("u", "part", "v"))))
            for chunk, data, offsets in text_chunks(heads, batch.column("text")):
                sets, at = shingle_sets(*word_hashes(data, offsets, powers), size)
                for (u, part, v), a, b in zip(chunk, at, at[1:]):
                    if v is None:
                        now, own = (u, part), sets[a:b]
                    elif now == (u, part):
                        n, m = len(own), b - a
                        if 100 * min(n, m) >= per_cent * max(n, m):
                            found = np.searchsorted(own, sets[a:b])
                            both = np.count_nonzero(own[np.minimum(found, n - 1)] == sets[a:b])
                            if 100 * both >= per_cent * (n + m - both):
                                good.append((u, v))
            yield from batches_of({"u": [x[0] for x in good], "v": [x[1] for x in good]}, schema)

    return run


def _verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough. A node with many partners is dealt to several tasks."""
    many = pairs.groupBy("u").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / GROUP)
    heads = many.select("u", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    heads = heads.join(texts, heads.u == texts.node).select("u", "part", F.lit(None).cast("long").alias("v"), "text")
    dealt = pairs.join(many, "u").withColumn("part", F.pmod(F.xxhash64("v"), parts))
    members = dealt.join(texts, dealt.v == texts.node).select("u", "part", "v", "text")
    rows = heads.unionByName(members)
    rows = rows.repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())
    return kept_table(spark, rows.mapInArrow(_check_pairs(size, per_cent), "u long, v long"), "links")


def _open_pairs(table: pa.Table, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each asking row the rows of other components that it first meets in this bucket and whose sketches allow the
    similarity, and the number of coordinates on which they agree."""
    asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    label = table.column("label").to_numpy()
    coords = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SIZE)
    bands = np.array(table.column("bands").to_pylist(), np.int64)
    others = np.flatnonzero(~asks)
    before = int(np.flatnonzero(bands[0] == table.column("bucket")[0].as_py())[0])
    earlier, theirs, labels = bands[others, :before], coords[others], label[others]
    for i in np.flatnonzero(asks):
        ok = np.flatnonzero((labels != label[i]) & ~(earlier == bands[i, :before]).any(axis=1))
        same = (theirs[ok] == coords[i]).sum(axis=1)
        yield i, others[ok[same >= least]], same[same >= least]


def _least(per_cent: int) -> int:
    share = per_cent / 100
    return math.floor(SIZE * share - DEVIATIONS * math.sqrt(SIZE * share * (1 - share)))


def _second_hubs(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (u, v): each node v outside its bucket's largest component with the node u that stands for that component in
    most of v's buckets, the component's node with the smallest hash in the bucket."""
    rows = met.select("bucket", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node"), "node")).alias("hub"))
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label", "hub.node")).alias("top"), F.count("*").alias("labels")).where("labels > 1")
    votes = rows.join(mixed, "bucket").where(F.col("label") != F.col("top.label")).groupBy(
        F.col("node").alias("v"), F.col("top.node").alias("u")).agg(F.count("*").alias("n"))
    best = votes.withColumn("k", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("n"), "u")))
    return best.where("k = 1").select("u", "v")


_BLOCK_COLUMNS = "bucket long, i long, j long, asks boolean, node long, label long"


def _concerned(per_cent: int):
    """The rows of a block that have a pair to verify."""
    names = ["bucket", "i", "j", "asks", "node", "label"]

    def run(table: pa.Table) -> pa.Table:
        use = np.zeros(table.num_rows, bool)
        for i, partners, _ in _open_pairs(table, _least(per_cent)):
            if len(partners):
                use[i] = True
                use[partners] = True
        return table.select(names).filter(pa.array(use))

    return run


def _connect(size: int, per_cent: int):
    """Links between components among the pairs of a block, by full sets."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        powers, sets = Powers(), []
        for _, data, offsets in text_chunks([None] * table.num_rows, table.column("text").combine_chunks()):
            got, at = shingle_sets(*word_hashes(data, offsets, powers), size)
            sets += [got[a:b] for a, b in zip(at, at[1:])]
        node, label = table.column("node").to_numpy(), table.column("label").to_pylist()
        top = {x: x for x in label}

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        links = []
        for i, partners, same in _open_pairs(table, _least(per_cent)):
            for j in partners[np.argsort(-same, kind="stable")]:
                a, b = sets[i], sets[j]
                x, y = root(label[i]), root(label[j])
                if x != y and 100 * min(len(a), len(b)) >= per_cent * max(len(a), len(b)):
                    both = np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b)
                    if 100 * both >= per_cent * (len(a) + len(b) - both):
                        top[y] = x
                        links.append((node[i], node[j]))
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=schema)

    return run


def _links_across(spark: SparkSession, met: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Links (u, v) that connect different components of a bucket."""
    rows = met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("members"),
                                        F.count("*").alias("labels")).where("labels > 1")
    rows = rows.join(mixed, "bucket").withColumn("outside", F.col("label") != F.col("top.label"))
    askers, others = F.ceil((F.col("members") - F.col("top.n")) / BLOCK), F.ceil(F.col("members") / BLOCK)
    ask = rows.where("outside").select(
        "bucket", F.pmod(F.xxhash64("node"), askers).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("j"), F.lit(True).alias("asks"), "node", "label")
    answer = rows.select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), askers - 1)).alias("i"),
        F.pmod(F.xxhash64(F.col("node"), F.lit(1)), others).alias("j"), F.lit(False).alias("asks"), "node", "label")
    sketched = nodes.select("node", "sketch", "bands")
    dealt = ask.unionByName(answer).join(sketched, "node")
    left = kept_table(spark, dealt.groupBy("bucket", "i", "j").applyInArrow(_concerned(per_cent), _BLOCK_COLUMNS), "blocks")
    whole = left.join(sketched, "node").join(texts, "node")
    return kept_table(spark, whole.groupBy("bucket", "i", "j").applyInArrow(_connect(size, per_cent), "u long, v long"), "links")


def minhash_groups(spark: SparkSession, docs: DataFrame, size: int = 2, per_cent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, tie (CRC-32 of the text), n_shingles, component_id, kept, first.

    Words are the runs between ASCII white space, A-Z lower-cased; a text's set holds its distinct runs of ``size``
    words (all its words, if fewer). Texts are linked if 100 * intersection >= ``per_cent`` * union; component_id is the
    smallest doc_id reachable, kept tells whether it is the row's own. first tells whether the row has the smallest
    (doc_id, tie) reachable, so of each group one document is first, also where doc_ids are repeated or all null.

    A null or empty text, or one of white space only, has an empty set and is linked with nothing. Equal sets are
    linked. Rows of equal doc_id are rows of their own. A null doc_id is larger than any other: its row is kept only if
    nothing with a doc_id is reachable (component_id is then null). Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = kept_table(spark, base.mapInArrow(_sketch_texts(size), _SKETCHED_DDL), "sketches")
    full = rows.where("n_shingles > 0")
    nodes = kept_table(spark, full.groupBy("node").agg(F.min("doc_id").alias("low"), F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("at"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), "nodes")

    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    hubs = placed.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    met = kept_table(spark, placed.join(hubs, "bucket").select("bucket", "node", "hub"), "met")
    best = Window.partitionBy("u").orderBy(F.desc("n"), "v")
    first = met.where("node <> hub").groupBy(F.col("node").alias("u"), F.col("hub").alias("v")).agg(F.count("*").alias("n"))
    first = first.withColumn("k", F.row_number().over(best)).where("k = 1")
    pairs = kept_table(spark, first.select(F.col("v").alias("u"), F.col("u").alias("v")), "pairs")

    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("d"), F.col("doc_id").isNull().alias("none"),
                         F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie"), "text")
    wanted = met.select("node").distinct().join(nodes, "node").select(
        "node", F.coalesce("at.doc_id", F.lit(-1)).alias("d"), F.col("at.none").alias("none"), F.col("at.tie").alias("tie"))
    texts = kept_table(spark, source.join(wanted, ["d", "none", "tie"]).dropDuplicates(["node"]).select("node", "text"), "texts")

    links = _verified(spark, pairs, texts, size, per_cent)
    labels = components(spark, links)
    again = _second_hubs(met, labels).join(pairs, ["u", "v"], "left_anti")
    links = links.unionByName(_verified(spark, kept_table(spark, again, "pairs"), texts, size, per_cent))
    labels = components(spark, links)
    more = _links_across(spark, met.select("bucket", "node"), labels, nodes, texts, size, per_cent)
    if more.limit(1).count():
        labels = components(spark, links.unionByName(more))

    named = nodes.select("node", "low", "at").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"), F.min("at").alias("least"))
    found = named.join(lows, "label").select("node", "component_id", "least")
    out = rows.select("doc_id", "tie", "n_shingles", "node").join(found, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    first = (F.col("n_shingles") == 0) | (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("tie") == F.col("least.tie")))
    return out.select("doc_id", "tie", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), first.alias("first"))
