"""Surrogate keys and line numbers without sorting a large group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.operators.lookup import broadcast_if_few
from kontor.session import stored

# Copies of one row that a single task may write out.
COPY_LIMIT = 1_000_000

# Parts that rows without a key are dealt out to.
_SPREAD = 1 << 20

# Rows of a group that one task may sort.
LARGE = 1 << 20

# monotonically_increasing_id holds the partition above this bit.
_SLICE_BIT = 33


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def expand_copies(df: DataFrame, copies: str, out: str, limit: int = COPY_LIMIT) -> DataFrame:
    """Repeat each row ``copies`` times, numbered from 1 in ``out``; never for 0.

    A row with many copies is first cut into ranges of at most ``limit``, which
    are spread over the tasks.  The number of tasks is given: judged by their
    size, the ranges would all be put into one.
    """
    ranges = df.filter(F.col(copies) > 0).withColumn(
        "_range", F.explode(F.expr(f"sequence(0L, (`{copies}` - 1) DIV {limit})"))
    ).repartition(_tasks(df), *df.columns, "_range")
    first = F.col("_range") * limit + 1
    last = F.least(F.col(copies).cast("bigint"), (F.col("_range") + 1) * limit)
    return ranges.withColumn(out, F.explode(F.sequence(first, last))).drop("_range")


def number_rows(df: DataFrame, order: Sequence, out: str, start=1) -> DataFrame:
    """Consecutive numbers from ``start`` in the given order.

    The remaining columns break ties, and equal rows are told apart by where
    they were read, so range partitioning spreads any distribution with one
    exchange.  The positions are stored before the offsets of the slices are added: both
    must see the same partitioning even if an executor is lost in between.
    ``start`` may be a column without reference to rows, such as a scalar
    subquery.
    """
    sorting = [*order, *[F.col(name).asc_nulls_last() for name in (*df.columns, "_read")]]
    placed = stored(
        df.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(_tasks(df), *sorting)
        .sortWithinPartitions(*sorting)
        .select(*df.columns, F.monotonically_increasing_id().alias("_place"))
    )
    placed = placed.withColumn("_slice", F.shiftright("_place", _SLICE_BIT))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_place") - F.shiftleft(F.col("_slice"), _SLICE_BIT)
    number = inside + F.col("_offset") + (F.lit(start) if isinstance(start, int) else start)
    # One offset per slice: bounded by the number of partitions.
    return placed.join(F.broadcast(offsets), "_slice").select(
        *df.columns, number.cast("bigint").alias(out)
    )


def assign_keys(df: DataFrame, order: Sequence, out: str, start: int = 1) -> DataFrame:
    """Surrogate keys, the key column first."""
    numbered = number_rows(df, order, out, start)
    return numbered.select(out, *df.columns)


def _known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in keys:
        known = known & F.col(name).isNotNull()
    return known


def _without_number(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """The rows with a null key: they have no number, and are never brought together."""
    return df.filter(~_known(keys)).withColumn(out, F.lit(None).cast("int"))


def number_within(df: DataFrame, partition: Sequence[str], order: Sequence, out: str) -> DataFrame:
    """Row numbers inside groups, null where a key is null; for few groups of any size.

    The first number of each group is stored and, counted to be few, broadcast: no rows are brought
    together by their group again.
    """
    keyed = df.filter(_known(partition))
    numbered = number_rows(keyed, [*[F.col(name) for name in partition], *order], "_number")
    first = broadcast_if_few(stored(
        numbered.groupBy(*[F.col(name).alias(f"_{name}") for name in partition]).agg(
            F.min("_number").alias("_first")
        )
    ))
    same = [numbered[name] == first[f"_{name}"] for name in partition]
    return numbered.join(first, same, "inner").select(
        *df.columns, (F.col("_number") - F.col("_first") + 1).cast("int").alias(out)
    ).unionByName(_without_number(df, partition, out))


def line_number(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], out: str,
    sizes: DataFrame | None = None, bound: DataFrame | None = None, limit: int = LARGE,
    within: Sequence[str] = (),
) -> DataFrame:
    """Running number of each row inside its group, null where a key is null.

    ``order`` are column names, ascending, nulls last.  Rows meet once, by their key, and are
    numbered there.  A group of more than ``limit`` rows is numbered over ranges instead, by
    ``number_within``, so no task ever sorts one alone.  The large groups are told beforehand
    from ``sizes``, a frame with the keys and a row or a count ``rows`` for each line, by default
    the keys of ``df``; they are at most one in ``limit`` rows, so they are broadcast.  Where
    ``bound``, by default ``df``, has no more than ``limit`` rows, no group can have.  Rows with
    a null key pass with the others, dealt out by a hash of the row.  Rows that lie together by the
    columns ``within`` are numbered where they lie; a key must have one value of these only.
    """
    keys = list(partition)
    dealt = F.when(_known(keys), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD)).cast("int") + 1)
    ordering = [F.col(name).asc_nulls_last() for name in order]

    def numbered(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy("_dealt", *within, *keys).orderBy(*ordering)
        number = F.when(F.col("_dealt") == 0, F.row_number().over(window))
        return rows.withColumn("_dealt", dealt).select(*df.columns, number.alias(out))

    if (df if bound is None else bound).count() <= limit:
        return numbered(df)
    counted = (df if sizes is None else sizes).filter(_known(keys)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows") if sizes is None or "rows" not in sizes.columns
        else F.sum("rows").alias("_rows")
    )
    large = stored(counted.filter(F.col("_rows") > limit).select(
        *[F.col(name).alias(f"_{name}") for name in keys]))
    if large.isEmpty():
        return numbered(df)
    same = [df[name] == large[f"_{name}"] for name in keys]
    rest = df.join(F.broadcast(large), same, "left_anti")
    hot = df.join(F.broadcast(large), same, "left_semi")
    return numbered(rest).unionByName(number_within(hot, keys, ordering, out))
