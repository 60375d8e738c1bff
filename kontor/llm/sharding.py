"""Shards by a weighted hash tree: region, rack, shard.

At every level each child draws a random number from the key and its own name,
scaled by its weight (the weights of its leaves summed), and the smallest
draw wins.  A child's draw doesn't depend on its siblings, so raising the weight
of one moves keys only into it, and what moves stays inside the subtrees whose
weights change.  A shard that opens a new region takes rows only into itself.

* Law ``key``: the id and the tree decide.  Rows with equal ids go together; a
  null id is a key like any other.  Texts don't matter, equal ones included.
* Slots are gapless from 0 in every shard, in the order of a hash slice, then
  id, size and checksum.  A shard is numbered slice by slice, so no task holds
  a whole shard; offsets have one row for each shard and slice.
* An empty table gives an empty result; a null text has no bytes.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import draw, named, text_bytes, whole


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def regular_tree(shards: int, per_rack: int = 2, per_region: int = 4) -> list[Leaf]:
    """Equal shards, filled up rack by rack and region by region."""
    return [Leaf(n // per_region, n // per_rack, n) for n in range(shards)]


def _pick(key: Column, level: str, children: Column) -> Column:
    """The place, in its level, of the child with the smallest draw."""
    scores = F.transform(
        children,
        lambda child: F.struct(
            (-F.log(
                (draw(key, F.lit(level), child["name"].cast("string")) + F.lit(0.5))
                / F.lit(float(2**52))
            ) / child["weight"]).alias("score"),
            child["place"].alias("place"),
        ),
    )
    return F.array_min(scores)["place"]


def shard_of(key: Column, tree: Iterable[Leaf]) -> Column:
    """The shard of a text key."""
    leaves = list(tree)
    parents: list[tuple] = [()]
    chosen = F.lit(0)
    for depth, level in enumerate(("region", "rack", "shard"), 1):
        nodes: dict[tuple, float] = {}
        for leaf in leaves:
            nodes[leaf[:depth]] = nodes.get(leaf[:depth], 0.0) + leaf.weight
        paths = sorted(nodes)
        children = F.array(*[
            F.array(*[
                F.struct(
                    F.lit(path[-1]).alias("name"), F.lit(place).alias("place"),
                    F.lit(nodes[path]).alias("weight"),
                ) for place, path in enumerate(paths) if path[:-1] == parent
            ]) for parent in parents
        ])
        chosen = _pick(key, level, F.get(children, chosen))
        parents = paths
    return F.get(F.array(*[F.lit(path[-1]) for path in parents]), chosen).cast("int")


def text_key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def shards(
    docs: DataFrame,
    tree: list[Leaf],
    grown: list[Leaf] | None = None,
    text: str = "text",
    key: str = "doc_id",
    slices: int = 4096,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slices`` is the number of parts a shard is numbered in: choose it so that
    a part of a shard fits one task.
    """
    name = text_key(F.col("doc_id"))
    placed = docs.select(
        named(key).alias("doc_id"),
        (text_bytes(named(text)) + 1).alias("size"),
        F.crc32(whole(named(text))).alias("text_crc32"),
    ).select(
        "*",
        shard_of(name, tree).alias("shard"),
        shard_of(name, grown if grown is not None else tree).alias("grown_shard"),
        F.pmod(
            draw(name, F.col("text_crc32").cast("string"), F.lit("slice")), F.lit(slices)
        ).cast("int").alias("slice"),
    )
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "size")
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = placed.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("rows")).select(
        "shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    return (
        placed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "slice"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("start") + F.col("inside")).cast("bigint").alias("slot"), "grown_shard",
        )
    )
