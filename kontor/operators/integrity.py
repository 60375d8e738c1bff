"""Checks of the constraints a warehouse table should satisfy."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.numbering import LARGE, expand_copies
from kontor.session import stored

# Parts by hash in which rows are counted to tell large keys.
_PARTS = 1 << 16


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold nulls, with their number; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot(
        [], [F.col(name) for name in columns], "column_name", "null_count"
    ).filter(F.col("null_count") > 0)


def fk_orphans(fact: DataFrame, foreign_key: str, dimension: DataFrame, key: str) -> DataFrame:
    """Foreign keys without dimension row, with their number of fact rows.

    A null foreign key is allowed.  Fact rows are counted per key before the
    join, so a hot key meets the dimension once.
    """
    used = (
        fact.filter(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key).agg(F.count(F.lit(1)).alias("row_count"))
    )
    keys = dimension.select(F.col(key).alias("_key"))
    return used.join(keys, used[foreign_key] == keys["_key"], "left_anti")


@dataclass(frozen=True)
class Constraints:
    """What rows of a table must satisfy to be loaded.

    ``unique``: no two rows of a batch have the same key.  ``references``: for a column the
    table and key where its values must be; null is allowed.
    """

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def _large_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys of more than ``limit`` rows, as ``_key_*``, or None; at most one in ``limit`` rows.

    Rows are counted by a hash of the key first: where no hash has so many, no key has.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(_PARTS))
    parts = stored(
        df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > limit).select("_part")
    )
    if parts.isEmpty():
        return None
    counted = df.join(F.broadcast(parts), part == F.col("_part"), "left_semi").groupBy(
        *[F.col(name).alias(f"_key_{name}") for name in keys]
    ).agg(F.count(F.lit(1)).alias("_rows"))
    large = stored(counted.filter(F.col("_rows") > limit).drop("_rows"))
    return None if large.isEmpty() else large


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"_key_{name}"))
    return same


def _later_of_large(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_with_later`` for keys of any size.

    Equal rows are counted and travel as one, the first is found by an aggregation that combines
    before its exchange, and met by a join that skew handling can split.
    """
    columns = rows.columns
    order = F.struct(*columns)
    found = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    first = found.groupBy(*[F.col(name).alias(f"_key_{name}") for name in keys]).agg(
        F.min(order).alias("_first"))
    found = found.join(first, _same(keys)).withColumn("_later", order != F.col("_first"))
    found = expand_copies(found.select(*columns, "_copies", "_later"), "_copies", "_copy")
    return found.select(*columns, (F.col("_later") | (F.col("_copy") > 1)).alias("_later"))


def _with_later(batch: DataFrame, keys: Sequence[str], limit: int, place: Callable) -> DataFrame:
    """``batch`` with ``_later``: whether a row with its key comes before, in the order of all columns.

    Rows with one key meet once and are sorted; a key of more than ``limit`` rows is no single task's.
    """
    # Grouping takes negative zeros for zeros; so does the order.
    batch = batch.withColumns({
        field.name: (F.col(f"`{field.name}`") + F.lit(0.0)).cast(field.dataType)
        for field in batch.schema if isinstance(field.dataType, (T.FloatType, T.DoubleType))
    })
    window = Window.partitionBy(*keys).orderBy(*batch.columns)

    def met(rows: DataFrame) -> DataFrame:
        return place(rows).withColumn("_later", F.row_number().over(window) > 1)

    large = _large_keys(batch, keys, limit)
    if large is None:
        return met(batch)
    rest = batch.join(F.broadcast(large), _same(keys), "left_anti")
    hot = batch.join(F.broadcast(large), _same(keys), "left_semi")
    return met(rest).unionByName(place(_later_of_large(hot, keys)))


def checked(
    batch: DataFrame, rules: Constraints, tables: Mapping[str, DataFrame], limit: int = LARGE,
    place: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``batch`` with ``reasons``: the constraints each row breaks, none for a good row.

    Of rows with one key one is kept, the first in the order of all columns.  Keys of more than
    ``limit`` rows are told beforehand.  ``place`` partitions the rows by a column of the unique key;
    they meet where it puts them.
    """
    reasons = [F.when(F.col(name).isNull(), F.lit(f"null: {name}")) for name in rules.not_null]
    found = batch
    if rules.unique:
        found = _with_later(batch, list(rules.unique), limit, place)
        reasons.append(F.when(F.col("_later"), F.lit(f"repeated: {', '.join(rules.unique)}")))
    for name, (table, key) in rules.references.items():
        known = tables[table].select(F.col(key).alias(f"_known_{name}")).distinct()
        found = found.join(known, F.col(name) == F.col(f"_known_{name}"), "left")
        reasons.append(F.when(
            F.col(name).isNotNull() & F.col(f"_known_{name}").isNull(), F.lit(f"missing: {name}")))
    return found.select(*batch.columns, F.array_compact(F.array(*reasons)).alias("reasons"))
