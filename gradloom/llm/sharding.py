"""Sharding by a hierarchical weighted hash tree."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS_PER_RACK = 2
RACKS_PER_REGION = 2


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``name`` feeds the hash draws, so a node keeps its draws wherever the tree changes."""

    name: int
    weight: float
    children: tuple[Node, ...] = ()


def shard_tree(base: int, added: int = 0, weights: dict[int, float] | None = None) -> Node:
    """``base`` shards in racks of two and regions of two racks; each of the ``added`` ones is a region of its own.

    A node weighs what its children weigh. An added shard leaves every old node's weight alone, so rows move into it
    and nowhere else. A weight that grows draws rows into the shard, its rack and its region, at each level from siblings
    only; subtrees whose weights stay exchange no rows.
    """
    weights = weights or {}
    leaves = [Node(3_000_000_000 + i, weights.get(i, 1.0)) for i in range(base + added)]

    def above(level: int, nodes: list[Node], width: int, first: int = 0) -> list[Node]:
        groups = [tuple(nodes[i : i + width]) for i in range(0, len(nodes), width)]
        return [Node(level * 1_000_000_000 + first + i, sum(n.weight for n in g), g) for i, g in enumerate(groups)]

    regions = above(1, above(2, leaves[:base], SHARDS_PER_RACK), RACKS_PER_REGION)
    for i in range(added):
        rack = above(2, [leaves[base + i]], 1, first=500_000_000 + i)
        regions += above(1, rack, 1, first=500_000_000 + i)
    return Node(0, sum(r.weight for r in regions), tuple(regions))


def assign_shard(tree: Node, key: Column, seed: int = 0) -> Column:
    """The shard number of a key: at each of three levels the child with the largest ln(u) / weight is taken.

    u is a hash of key, child and seed in (0, 1), so a child is drawn in proportion to its weight, and changing one
    weight moves rows to or from that child only. All draws are column expressions; the tree is a literal whose
    size follows the number of shards, not of rows. Children of weight 0 are never drawn. A null key has draws as well.
    """
    path: Column = F.lit(0)
    level = [tree]
    for _ in range(3):
        children = [[c for c in node.children if c.weight > 0] for node in level]
        below = [c for group in children for c in group]
        places, at = [], 0
        for group in children:
            places.append(
                F.array(
                    *[
                        F.struct(F.lit(c.name).cast("bigint").alias("name"), F.lit(float(c.weight)).alias("weight"), F.lit(at + i).alias("at"))
                        for i, c in enumerate(group)
                    ]
                )
            )
            at += len(group)
        options = F.get(F.array(*places), path)
        drawn = F.transform(options, lambda c: F.struct((_log_uniform(key, c["name"], seed) / c["weight"]).alias("score"), c["at"].alias("at")))
        path = F.array_max(drawn)["at"]
        level = below
    shards = F.array(*[F.lit(node.name - 3_000_000_000) for node in level])
    return F.get(shards, path).cast("int")


def _log_uniform(key: Column, name: Column, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key, F.lit(-1)), name, F.lit(seed).cast("bigint")), 11)
    return F.ln((bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53))


def shard_rows(df: DataFrame, key: str, tree: Node, out: str = "shard", seed: int = 0) -> DataFrame:
    """Add the shard of every row; a column of that name is replaced.

    Only the key decides: rows of equal keys share a shard, a null key counts as -1, repeated rows stay, an empty
    table stays empty. Nothing is shuffled.
    """
    return df.withColumn(out, assign_shard(tree, F.col(key), seed))
