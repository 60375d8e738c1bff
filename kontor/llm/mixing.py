"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words.  A document of a source with ``s`` words and
target ``t`` is expected ``t / s`` times.  The expectations are summed up along the
source, from the longest document to the shortest, one random offset is added,
and a copy is emitted for every integer boundary that a document crosses.

* Sources are ordered by code point, null last, and weigh 1, 2, 3, 1, 2, ... by
  default.  Targets share the words of all sources, but none is above
  ``most`` times its source's words; what is above is shared by weight again.
* Neighbours along a source are of like length, so its words come within about
  one document of the target.  No document is taken more than ``most`` times.
* Sums are in whole numbers (units of 2^-24), so every engine and rerun agrees.
* A source without words has target 0, and its documents aren't taken.  Null
  texts have no words.  Rows that repeat in all columns are drawn one by one.
* An empty table gives an empty result.  Sources may be of any size and number:
  both are ordered by range partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import draw, fresh, named, prefix_sums, whole, word_count
from kontor.session import stored

SCALE_BITS = 24


def cycling_weight(place: Column, cycle: int = 3) -> Column:
    """1, 2, ... ``cycle``, 1, 2, ... for places from 0."""
    return F.pmod(place, F.lit(cycle)) + 1


def source_targets(sizes: DataFrame, share: float = 1.0, most: int = 3) -> DataFrame:
    """source, source_size, target from (source, size) of documents."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = prefix_sums(totals, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    weighed = ranked.withColumn("weight", cycling_weight(F.col("place")).cast("double"))
    cap = (F.col("source_size") * most).cast("double")
    filled = stored(prefix_sums(
        weighed.withColumn("cap", cap),
        [F.col("cap") / F.col("weight"), F.col("place")],
        {"caps": F.col("cap"), "weights": F.col("weight")},
    ))
    # A source at its cap leaves the rest to the others: the level of the others
    # is the largest that any prefix of capped sources gives.
    total = filled.agg((F.sum("source_size") * F.lit(float(share))).alias("total")).scalar()
    weight = filled.agg(F.sum("weight").alias("weight")).scalar()
    level = filled.agg(F.max((total - F.col("caps")) / (weight - F.col("weights")))).scalar()
    return filled.select(
        "source", "source_size",
        F.least(F.col("cap"), F.greatest(F.lit(0.0), F.col("weight") * level)).alias("target"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
    share: float = 1.0,
    most: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken; and ``mark``,
    a hash of the row's key, source and text."""
    sizes = stored(docs.select(
        named(key).alias("doc_id"), named(source).alias("source"),
        word_count(named(text)).alias("size"), _mark(docs, text, key, source).alias("mark"),
    ))
    targets = stored(source_targets(sizes, share, most))
    order = [
        F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id"), F.col("mark")
    ]
    ranked = prefix_sums(sizes, order, {"place": F.lit(1)}, within=["source"])
    rates = targets.select(
        F.col("source").alias("of"), "source_size", "target",
        F.coalesce(
            F.least(
                F.round(F.expr(f"target / nullif(source_size, 0) * {1 << SCALE_BITS}")),
                F.lit(float(most << SCALE_BITS)),
            ), F.lit(0.0),
        ).cast("bigint").alias("rate"),
        F.pmod(
            draw(F.lit(seed), F.coalesce(F.col("source"), F.lit("null"))),
            F.lit(1 << SCALE_BITS),
        ).alias("offset"),
    )

    def boundary(place: Column) -> Column:
        return F.shiftright(F.col("offset") + place * F.col("rate"), SCALE_BITS)

    return ranked.join(rates, ranked["source"].eqNullSafe(rates["of"])).withColumn(
        "copies", boundary(F.col("place") + 1) - boundary(F.col("place"))
    ).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), "mark",
    )


def _mark(docs: DataFrame, text: str, key: str, source: str) -> Column:
    parts = [named(key), named(source), whole(named(text))]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(*reversed(parts)).alias("b"))


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
          **options) -> DataFrame:
    """The documents, each as often as the mix takes it, all columns as they are.

    Rows that agree in key, source and text are one document here; those of them
    that the mix takes are copies of any one of them.
    """
    mark, copies = fresh(docs, "_mark", "_copies")
    taken = stored(
        mix(docs, text, key, source, **options).groupBy("mark")
        .agg(F.sum("copies").alias(copies)).filter(F.col(copies) > 0)
        .withColumnRenamed("mark", mark)
    )
    return (
        docs.withColumn(mark, _mark(docs, text, key, source))
        .join(taken, mark).dropDuplicates([mark])
        .withColumn(copies, F.explode(F.sequence(F.lit(1).cast("bigint"), named(copies))))
        .drop(mark, copies)
    )
