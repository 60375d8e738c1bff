"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.session import stored

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that a Python worker gets at once, unless the session says otherwise.
BATCH = "4m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, whatever the case."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole(text: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(text, F.lit(""))


def text_bytes(text: Column) -> Column:
    """Length in UTF-8; null counts as empty."""
    return F.octet_length(whole(text)).cast("bigint")


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def draw(*parts: Column) -> Column:
    """52 random bits as a bigint, the same for the same parts on every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13), 16, 10).cast("bigint")


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, of whose rows a Python worker gets some ``BATCH`` bytes at once.

    By default batches end at 10,000 rows or 64 MB, so one of texts may be a task's whole
    input, which the executor and its worker then hold several times over.  The limit is the
    session's and stays set, as plans read it when they run; one already given is kept.
    """
    conf = df.sparkSession.conf
    if _BATCH_KEY not in conf.getAll:
        conf.set(_BATCH_KEY, BATCH)
    return df


def prefix_sums(
    df: DataFrame, order: Sequence[Column], sums: dict[str, Column], within: Sequence[str] = ()
) -> DataFrame:
    """Sums over all earlier rows in the given order, by columns ``sums`` names.

    ``within`` are columns the order begins with; sums start anew for each of
    their values.  Rows are range-partitioned and stored, so that a lost
    executor cannot change the partitioning that the offsets were taken from.
    No group meets in one task: a task holds a range of rows, and the offsets
    have one row for each range and group that begins in it.
    """
    part, place = fresh(df, "_part", "_place")
    values = fresh(df, *[f"_{name}_" for name in sums])
    placed = stored(
        df.withColumns(dict(zip(values, sums.values(), strict=True)))
        .repartitionByRange(tasks(df), *order)
        .sortWithinPartitions(*order)
        .withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()})
    )
    keys = [part, *within]
    inside = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys).agg(*[F.sum(value).alias(value) for value in values])
    offset = fresh(placed, *[f"_{name}_offset" for name in sums])
    starts = totals.select(
        *[named(key).alias(f"{key}__") for key in keys],
        *[
            F.coalesce(F.sum(value).over(before), F.lit(0)).alias(name)
            for value, name in zip(values, offset, strict=True)
        ],
    )
    same = [placed[key].eqNullSafe(starts[f"{key}__"]) for key in keys]
    local = [F.coalesce(F.sum(value).over(inside), F.lit(0)) for value in values]
    summed = placed.withColumns(
        {f"{value}_": column for value, column in zip(values, local, strict=True)}
    )
    return summed.join(starts, same).select(
        *[named(name) for name in df.columns],
        *[
            (F.col(f"{value}_") + F.col(start)).alias(name)
            for name, value, start in zip(sums, values, offset, strict=True)
        ],
    )
