"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.session import stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """Of each ``a`` the smallest ``b``, stored so that the join that follows may
    split or broadcast: a hub has as many pairs as its component has nodes."""
    return stored(
        pairs.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "of")
    )


def _signature(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """node, root for every node with links (bigints a and b); root is the
    smallest node of the component, and roots themselves are left out.

    Large-star and small-star steps by turns: every node links its larger
    neighbours, then its smaller ones and itself, to the smallest node next to it, until
    nothing changes.  Each round is stored, and the links never leave the cluster.
    """
    links = stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _signature(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _smallest(both)
        large = stored(
            both.filter("b > a").join(least, F.col("a") == F.col("of"))
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        )
        least = _smallest(large)
        small = large.join(least, F.col("a") == F.col("of")).filter("b <> least").select(
            F.col("b").alias("a"), F.col("least").alias("b")
        )
        links = stored(
            small.unionByName(least.select(F.col("of").alias("a"), F.col("least").alias("b")))
            .distinct()
        )
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
