"""Operator 11, centroid clustering by a bisector tournament in whole numbers.

Components become whole numbers, floor(scale * x), so that every comparison is exact. For centroids i < j the plane half-way
between them has the normal 2 * (c_j - c_i) and the threshold |c_j|^2 - |c_i|^2: a vector v is nearer to j exactly if
v . normal > threshold, and at equality i, the smaller number, wins. Normals and thresholds of all pairs are worked out once
a round and task. A vector's winner so far meets the next centroid in one such test, so k - 1 linear tests leave the nearest
one; only its distance is then worked out.

Each round is one pass over the vectors: a task adds up its vectors by cluster, and only these sums (k rows a task) are
shuffled and, added up by (cluster, component), brought to the driver: k times dimension numbers, whatever the input. The pair
table takes 4 * k^2 * dimension bytes a task (0.4 MB at k = 40 and 64 components), which bounds k to some hundreds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import batches_of, kept_table

#: Up to this size of its whole-number components a vector is worked on in 64-bit integers, beyond in Python's own.
NARROW = 1 << 27
#: Largest size of a component that is clustered: sums over all vectors then fit decimal(38, 0).
WIDEST = 1 << 64
#: Vectors that one step works on.
CHUNK = 8192

_SUMS = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))])
_SUMS_DDL = "cluster int, n long, sums array<decimal(38,0)>"
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def whole_vectors(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of exactly ``dim`` components, none null or not finite, as whole numbers floor(scale * x), and their places
    in the column."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.array(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(lengths == dim)
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)  # a null is not a number here
    fine = np.isfinite(values).all(axis=1)
    at, values = at[fine], np.floor(values[fine] * scale)
    if not len(values):
        return np.zeros((0, dim), np.int64), at
    most = np.abs(values).max()
    if most > WIDEST:
        raise ValueError(f"a component of {most / scale:g} is beyond {WIDEST // scale:g}")
    if most <= NARROW:
        return values.astype(np.int64), at
    return np.array([[int(x) for x in row] for row in values], object), at


class Bisectors:
    """Normals and thresholds of all pairs of centroids, and the tournament over them."""

    def __init__(self, centroids: list[list[int]]) -> None:
        c = np.array(centroids, object)
        narrow = max(map(abs, c.ravel()), default=0) <= NARROW
        self.centroids = c.astype(np.int64) if narrow else c
        squares = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])  # of (i, j), i < j is used
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector, the smaller one at ties, and the squared distance to it."""
        winner = np.zeros(len(vectors), np.int64)
        for j in range(1, len(self.centroids)):
            side = (vectors * self.normals[winner, j]).sum(axis=1) - self.thresholds[winner, j]
            winner = np.where((side > 0).astype(bool), j, winner)
        apart = vectors - self.centroids[winner]
        return winner, (apart * apart).sum(axis=1)


def _chunks(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            vectors, at = whole_vectors(part.column("embedding"), dim, scale)
            if len(at):
                yield part, vectors, at


def _sums(centroids: list[list[int]], dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        n, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dim), object)
        for _, vectors, _ in _chunks(batches, dim, scale):
            winner, _ = planes.nearest(vectors)
            for c in np.unique(winner):
                own = vectors[winner == c]
                n[c] += len(own)
                sums[c] += own.sum(axis=0)
        some = np.flatnonzero(n)
        rows = {"cluster": some, "n": n[some], "sums": [list(map(int, sums[c])) for c in some]}
        yield pa.record_batch([pa.array(rows["cluster"], pa.int32()), pa.array(rows["n"]),
                               pa.array(rows["sums"], pa.list_(pa.decimal128(38, 0)))], schema=_SUMS)

    return run


def _assign(centroids: list[list[int]], dim: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        for part, vectors, at in _chunks(batches, dim, scale):
            winner, distance = planes.nearest(vectors)
            if distance.dtype == object:
                distance = [int(d) if d < 1 << 63 else None for d in distance]
            ids = part.column("vec_id").take(pa.array(at))
            yield from batches_of({"vec_id": ids, "cluster": winner, "distance": distance}, _ASSIGNED)

    return run


def _kept(batches: Iterator[pa.RecordBatch], dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, at = whole_vectors(batch.column("embedding"), dim, scale)
        yield batch.take(pa.array(at))


def first_centroids(vectors: DataFrame, k: int, dim: int, scale: int, seed: str) -> list[list[int]]:
    """The ``k`` usable vectors of smallest sha256 of ``seed:vec_id``, in ascending order of that hash, as whole numbers. Null ids
    come last; rows of one id go by their components. Only k rows reach the driver."""
    usable = vectors.mapInArrow(lambda batches: _kept(batches, dim, scale), vectors.schema)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = usable.orderBy(rank.asc_nulls_last(), "embedding").limit(k).select("embedding").toArrow()
    whole, _ = whole_vectors(first.column("embedding").combine_chunks(), dim, scale) if first.num_rows else (np.zeros((0, dim), int), None)
    return [list(map(int, row)) for row in whole]


def next_centroids(vectors: DataFrame, centroids: list[list[int]], dim: int, scale: int) -> list[list[int]]:
    """One round: the exact mean of each cluster's vectors, rounded down; a centroid without vectors stays."""
    sums = vectors.mapInArrow(_sums(centroids, dim, scale), _SUMS_DDL)
    long = sums.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    added = long.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("part").alias("total")).toArrow().to_pylist()
    out = [list(c) for c in centroids]
    for r in added:
        out[r["cluster"]][r["place"]] = int(r["total"]) // r["n"]
    return out


def centroid_clusters(spark: SparkSession, vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256,
                      seed: str = "2") -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding): vec_id, cluster, distance (squared, to the final centroid),
    cluster_inertia and inertia (distances summed over the cluster and over all), centroid (its components) and centroid_sha256.

    Usable are vectors of exactly ``dim`` components, none null or not finite; other rows give none. Starts from
    ``first_centroids`` (fewer usable vectors than ``k`` give as many clusters), then ``rounds`` of assigning and moving, then
    vectors are assigned once more. Equal centroids: the smaller number gets the vectors. Repeated rows, and rows of one id,
    are vectors of their own; a null vec_id is kept. An empty table gives no rows. Other columns are ignored. Components up
    to 2^64 / ``scale`` in size are exact, larger ones raise; a distance or sum that a long doesn't hold is null."""
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = first_centroids(base, k, dim, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(base.select("embedding"), centroids, dim, scale)
    if centroids:
        assigned = base.mapInArrow(_assign(centroids, dim, scale), "vec_id long, cluster int, distance long")
        assigned = kept_table(spark, assigned, "assigned")
    else:
        assigned = base.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    inertia = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(
        F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)"))).alias("total")).collect()}

    def held(x):
        return int(x) if x is not None and x < 1 << 63 else None

    everything = held(sum(inertia.values())) if None not in inertia.values() else None
    rows = [(c, held(total), everything, list(map(str, centroids[c])),
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, total in inertia.items()]
    # one row a cluster: at most k
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<string>, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.col("centroid").cast("array<decimal(38,0)>").alias("centroid"), "centroid_sha256")
