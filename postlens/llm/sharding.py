"""Operator 3, sharding by a hierarchical weighted hash tree (DataFrame functions only).

A tree of regions, racks and shards; every node has the summed weight of its shards. A row descends from the root: at
each level every child draws -ln(u) / weight, u from a hash of the row's id and the child's name, and the smallest draw
takes the row, so a child gets its share of the weight. A draw depends on nothing but the row, the child and the child's
weight: when weights change, rows move only into or out of subtrees whose weight changed. New shards come as a region of
their own (``grown``), so that rows move only into the new shards.

Slots number a shard's rows without gaps. Rows of a shard are numbered inside hash parts, after the summed sizes of the
parts before, so no task sees a whole shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import kept_table

#: Rows of one part of a shard, about.
PART_ROWS = 20_000


@dataclass(frozen=True)
class Node:
    """A region, rack or shard: a name, unique among its siblings, and children or else a shard number and weight."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def balanced(shards: int, racks: int = 2, per_rack: int = 2) -> Node:
    """Shards 0 to ``shards`` - 1 of weight 1, ``per_rack`` to a rack and ``racks`` racks to a region."""
    made = [Node(f"shard{i}", shard=i) for i in range(shards)]
    rows = [Node(f"rack{i}", tuple(made[i : i + per_rack])) for i in range(0, shards, per_rack)]
    return Node("root", tuple(Node(f"region{i}", tuple(rows[i : i + racks])) for i in range(0, len(rows), racks)))


def grown(root: Node, shards: int = 1) -> Node:
    """``root`` with more shards, in a region of their own."""
    def count(x: Node) -> int:
        return sum(map(count, x.children)) if x.children else 1

    n = count(root)
    new = tuple(Node(f"shard{n + i}", shard=n + i) for i in range(shards))
    return Node(root.name, (*root.children, Node(f"region-from-{n}", (Node(f"rack-from-{n}", new),))))


def descend(root: Node, key: Column) -> Column:
    """The shard that ``key`` falls to."""
    if not root.children:
        return F.lit(root.shard)

    def draw(path: str, child: Node) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11).cast("double") + 0.5) / float(1 << 53)
        return -F.log(u) / F.lit(float(child.weight))

    def below(node: Node, path: str) -> Column:
        if not node.children:
            return F.lit(node.shard)
        live = [c for c in node.children if c.weight > 0]
        if not live:
            raise ValueError(f"{path} has no weight")
        best = F.array_min(F.array(*(F.struct(draw(f"{path}/{c.name}", c).alias("draw"), F.lit(i).alias("i"))
                                     for i, c in enumerate(live))))["i"]
        out = below(live[-1], f"{path}/{live[-1].name}")
        for i, c in reversed(list(enumerate(live[:-1]))):
            out = F.when(best == i, below(c, f"{path}/{c.name}")).otherwise(out)
        return out

    return below(root, root.name)


def hash_tree_shards(spark: SparkSession, docs: DataFrame, root: Node, new_root: Node | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('key'), shard,
    slot (gapless from 0 in each shard), grown_shard (with ``new_root``; else null).

    The shard depends on doc_id and the tree alone; rows of equal doc_id share it, and null doc_ids count as one more id.
    Slots follow (hash part, doc_id, size, CRC-32); rows equal in all of these are alike. A null text has size 1 and the
    CRC-32 of no bytes. Other columns are ignored."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.col("doc_id").cast("string")
    rows = docs.select("doc_id", (F.octet_length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("text_crc32"),
                       F.lit("key").alias("law"), descend(root, key).alias("shard"),
                       (descend(new_root, key) if new_root else F.lit(None).cast("int")).alias("grown_shard"))
    rows = kept_table(spark, rows, "sharded")
    parts = max(1, -(-rows.count() // PART_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)))
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("shard", "part", before.alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")) - 1
    out = rows.withColumn("within", within).join(sizes, ["shard", "part"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("base") + F.col("within")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """The documents as Parquet, one folder a shard; ``placed`` comes from hash_tree_shards over the same documents."""
    where = placed.select(F.col("doc_id").alias("__id"), "shard").distinct()
    out = docs.join(where, docs.doc_id.eqNullSafe(F.col("__id"))).drop("__id")
    out.write.partitionBy("shard").parquet(path)
