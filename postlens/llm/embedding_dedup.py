"""Operator 6, embedding near-dedup by a forest of random-projection trees with spill overlap.

Vectors are compared only inside their label. Equal vectors are one node, weighted by its rows. Each of the ``TREES`` trees
splits a label's unit vectors again and again at the median along a random direction; what lies within ``SPILL`` standard
deviations of a wanted pair's own spread around the split goes to both sides. A node is not split where that would not
save comparisons: in a group of near copies most vectors lie that close to every median. Such a node is a leaf, however
large; if it is a tree's root, the label is compared as a whole.

Trees grow in tiers, so that they get as deep as a label is large. A tier takes every leaf of more than ``SPLIT`` vectors
(in the first tier: every label of more than ``LEAF``), finds medians for up to log2(SAMPLE / 4) levels from about ``SAMPLE``
of its vectors (smallest hashes), and sends all its vectors down; leaves that are still too large wait for the next tier, with
directions of their own. Leaves of spread-out vectors hold ``SPLIT`` at most, however many vectors there are. The
medians of a leaf are found in one task and meet its vectors in pieces of about ``PIECE``; nothing but the question whether a
leaf is still too large goes through the driver, and there is no bound on the number of labels.

A node has the list of all its leaves, in all trees. Inside a leaf all pairs are compared, in blocks, by cosine in
double precision; a linked pair counts in the first leaf that both share, so each pair counts once, and only sums by
node and a spanning set of links leave the task. Dense clusters make large leaves: these are dealt as pairs of blocks of
``BLOCK`` rows to several tasks.

A pair at cosine 0.98 among spread-out vectors (64 components) is parted at a level with a probability of about 0.0014, so
it misses a tree of depth 7 with about 0.01 and all ``TREES`` with about 1e-12 (depth 20: 0.03 and 5e-10). Where a median cuts
through the middle of a group whose pairs lie around the limit, that level parts about 0.012 of them; a few such cuts, until the
group fills the node and splitting stops, leave about 1e-8 over all trees. These are estimates, for normally spread vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import U64, components, kept_table, mix, signed

TREES, LEAF, SPLIT, SAMPLE, PIECE, SPILL, BLOCK = 6, 96, 1024, 4096, 8192, 1.0, 384


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    """A column of lists of one length as unit vectors."""
    return unit(np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(len(column), -1))


def directions(depth: int, dim: int, seed: list[int]) -> np.ndarray:
    """One unit direction a level."""
    ways = np.random.default_rng(seed).standard_normal((depth, dim))
    return ways / np.sqrt((ways * ways).sum(axis=1, keepdims=True))


def grow(sample: np.ndarray, ways: np.ndarray, margin: float) -> np.ndarray:
    """Medians of the inner nodes, in heap order; NaN where the node stays whole: no sample came there, or the halves with
    their overlap make as many pairs as the node."""
    along = sample @ ways.T
    medians = np.full(1 << len(ways), np.nan)
    row, at = np.arange(len(sample)), np.ones(len(sample), np.int64)
    for level in range(len(ways)):
        for node in np.unique(at[at >= 1 << level]):
            here = along[row[at == node], level]
            middle = np.median(here)
            if (here - middle <= margin).mean() ** 2 + (here - middle > -margin).mean() ** 2 < 1:
                medians[node] = middle
        row, at = _down(along[:, level], row, at, medians, margin)
    return medians


def _down(along: np.ndarray, row: np.ndarray, at: np.ndarray, medians: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """One level further; inside the margin a row goes both ways, and at a node that stays whole it stays."""
    off = along[row] - medians[at]
    left, right, stay = off <= margin, off > -margin, np.isnan(off)
    return np.concatenate([row[left], row[right], row[stay]]), np.concatenate([2 * at[left], 2 * at[right] + 1, at[stay]])


def _seeds(seed: int, tier: int, leaf: int) -> list[list[int]]:
    """A seed for each tree that a leaf grows: ``TREES`` from a label, one from a leaf of an earlier tier."""
    return [[seed, tier, t, leaf & 0xFFFFFFFFFFFFFFFF] for t in range(1 if tier else TREES)]


def _plant(margin: float, seed: int, tier: int):
    """From the sample of a leaf the medians of its trees; none if one of them keeps the leaf whole."""
    schema = pa.schema([("kind", pa.int64()), ("leaf", pa.int64()), ("n", pa.int64()), ("medians", pa.list_(pa.list_(pa.float64())))])
    deepest = int(math.log2(SAMPLE / 4))

    def run(table: pa.Table) -> pa.Table:
        kind, leaf, n = (table.column(c)[0].as_py() for c in ("kind", "leaf", "n"))
        x = unit_rows(table.column("embedding"))
        dim, depth = x.shape[1], min(math.ceil(math.log2(n / LEAF)), deepest)
        medians = []
        for s in _seeds(seed, tier, leaf):
            medians.append(grow(x, directions(depth, dim, s), margin / math.sqrt(dim)))
            if math.isnan(medians[-1][1]):
                return schema.empty_table()
        return pa.table([[kind], [leaf], [n], [[m.tolist() for m in medians]]], schema=schema)

    return run


def leaves(x: np.ndarray, ways: np.ndarray, medians: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for each leaf that each row reaches."""
    along = x @ ways.T
    row, at = np.arange(len(x)), np.ones(len(x), np.int64)
    for level in range(len(ways)):
        # a node that stayed whole above has no deeper medians
        row, at = _down(along[:, level], row, at, medians, margin)
    return row, at


def _enter(margin: float, seed: int, tier: int):
    """A piece of a leaf's vectors meets the leaf's medians: the leaves below that each vector reaches."""
    schema = pa.schema([("kind", pa.int64()), ("node", pa.int64()), ("leaf", pa.int64())])

    def run(key: tuple, vectors: pa.Table, trees: pa.Table) -> pa.Table:
        if not len(vectors) or not len(trees):
            return schema.empty_table()
        kind, leaf, _ = (k.as_py() for k in key)
        x, node = unit_rows(vectors.column("embedding")), vectors.column("node").to_numpy()
        base = mix(np.array([leaf], np.int64).view(U64))
        nodes, names = [], []
        for t, (s, median) in enumerate(zip(_seeds(seed, tier, leaf), trees.column("medians")[0].as_py())):
            ways = directions(len(median).bit_length() - 1, x.shape[1], s)
            row, at = leaves(x, ways, np.array(median), margin / math.sqrt(x.shape[1]))
            nodes.append(node[row])
            names.append(signed(mix(base + U64(t << 40) + at.astype(U64))))
        nodes = np.concatenate(nodes)
        return pa.table([np.full(len(nodes), kind), nodes, np.concatenate(names)], schema=schema)

    return run


def forest(spark: SparkSession, nodes: DataFrame, margin: float, seed: int) -> DataFrame:
    """(kind, node, leaf): the leaves of each node (kind, node, embedding). A kind without trees is one leaf."""
    held, done, tier = nodes.select("kind", "node", F.col("kind").alias("leaf")), [], 0
    while True:
        large = held.groupBy("kind", "leaf").agg(F.count("*").alias("n")).where(F.col("n") > (SPLIT if tier else LEAF))
        large = kept_table(spark, large, "large")
        if large.limit(1).count() == 0:
            break
        vectors = held.join(large, ["kind", "leaf"]).join(nodes.select("node", "embedding"), "node")
        vectors = kept_table(spark, vectors, "vectors") if tier else nodes.withColumn("leaf", F.col("kind")).join(large, ["kind", "leaf"])
        drawn = F.shiftrightunsigned(F.xxhash64("node", F.lit(seed + tier)), 11) / float(1 << 53) < SAMPLE / F.col("n")
        trees = vectors.where(drawn).select("kind", "leaf", "n", "embedding").groupBy("kind", "leaf").applyInArrow(
            _plant(margin, seed, tier), "kind long, leaf long, n long, medians array<array<double>>")
        trees = kept_table(spark, trees, "trees")
        split = trees.select("kind", "leaf")
        done.append(held.join(split, ["kind", "leaf"], "left_anti"))
        pieces = F.ceil(F.col("n") / PIECE)
        trees = trees.select("kind", "leaf", "medians", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
        vectors = vectors.join(split, ["kind", "leaf"], "left_semi").select(
            "kind", "leaf", "node", "embedding", F.pmod(F.xxhash64("node"), pieces).alias("piece"))
        by = ["kind", "leaf", "piece"]
        held = vectors.groupBy(*by).cogroup(trees.groupBy(*by)).applyInArrow(_enter(margin, seed, tier), "kind long, node long, leaf long")
        held, tier = kept_table(spark, held, "held"), tier + 1
    for more in done:
        held = held.unionByName(more)
    return held


def _compare(least: float):
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, leaf, i, j = (k.as_py() for k in key)
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        block = table.column("block").to_numpy()
        x = unit_rows(table.column("embedding"))
        lists = table.column("leaves").to_pylist()
        earlier = [[t for t in own if t < leaf] for own in lists]
        names = {t: k for k, t in enumerate(sorted({t for own in earlier for t in own}))}
        member = np.zeros((len(node), len(names)), np.float32)
        for r, own in enumerate(earlier):
            member[r, [names[t] for t in own]] = 1
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        linked = x[a] @ x[b].T >= least
        if names:
            met = member[a] @ member[b].T > 0  # those pairs count in an earlier leaf
        else:
            met = np.zeros(linked.shape, bool)
        if i == j:
            linked &= a[:, None] < b[None, :]
        counted = linked & ~met
        n = np.zeros(len(node), np.int64)
        n[a] += counted @ weight[b]
        n[b] += counted.T @ weight[a]
        # a spanning set of the links that count here; the others are spanned in their own leaf
        near = np.zeros((len(node), len(node)), bool)
        near[np.ix_(a, b)] = counted
        near |= near.T
        new, edges = near.any(axis=1), []
        for start in np.flatnonzero(new):
            reached = [start] if new[start] else []
            new[start] = False
            while reached:
                k = reached.pop()
                more = np.flatnonzero(near[k] & new)
                new[more] = False
                reached.extend(more)
                edges.extend((k, m) for m in more)
        some = np.flatnonzero(n)
        return pa.table([pa.array(np.concatenate([node[some], [node[e[0]] for e in edges]]).astype(np.int64)),
                         pa.array([None] * len(some) + [int(node[e[1]]) for e in edges], pa.int64()),
                         pa.array(np.concatenate([n[some], np.zeros(len(edges), np.int64)]).astype(np.int64))], schema=schema)

    return run


def embedding_groups(spark: SparkSession, vectors: DataFrame, least: float = 0.98, seed: int = 7) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links (other rows linked directly),
    component_id (smallest vec_id reachable), kept (vec_id = component_id).

    Rows of equal label are linked if the cosine of their vectors, in double precision, is ``least`` or more. Linked with
    nothing (n_links 0, a component of their own): a null label; an embedding that is null, empty, all zero, or holds a
    null, NaN or infinite component; vectors of different lengths with each other. Rows of equal vec_id are rows of their
    own; a null vec_id counts as larger than any other. Other columns are ignored."""
    kept = vectors.schema["embedding"].dataType.simpleString()
    kept = kept if kept == "array<float>" else "array<double>"  # half the bytes to shuffle; widened before any sum
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kept).alias("embedding"), "label")
    usable = (F.col("label").isNotNull() & F.coalesce(F.size("embedding") > 0, F.lit(False))
              & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
              & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False)))
    rows = given.withColumn("node", F.when(usable, F.xxhash64("label", "embedding")))

    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.count("*").alias("weight"),
                                                               F.min("vec_id").alias("low"), F.first("embedding").alias("embedding"))
    nodes = kept_table(spark, nodes.withColumn("kind", F.xxhash64("label", F.size("embedding"))), "vectors")
    margin = SPILL * math.sqrt(2 - 2 * least)  # unit vectors at the limit lie this far apart, but for SPILL
    entered = kept_table(spark, forest(spark, nodes, margin, seed), "entered")
    lists = entered.groupBy("node").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    placed = nodes.select("node", "kind", "weight", "embedding").join(lists, "node").withColumn("leaf", F.explode("leaves"))
    large = entered.groupBy("kind", "leaf").agg(F.ceil(F.count("*") / BLOCK).alias("n")).where("n > 1")
    placed = placed.join(large, ["kind", "leaf"], "left").withColumn("blocks", F.coalesce("n", F.lit(1).cast("long")))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.select("kind", "leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                           "block", "node", "weight", "embedding", "leaves")
    found = kept_table(spark, placed.groupBy("kind", "leaf", "i", "j").applyInArrow(_compare(least), "node long, other long, n long"), "found")
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(spark, found.where("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v")))
    named = nodes.select("node", "low", "weight").join(labels, "node", "left").withColumn("component", F.coalesce("label", "node"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "component").join(counts, "node", "left").select(
        "node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"))
    out = rows.select("vec_id", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.col("vec_id").eqNullSafe(own).alias("kept"))
