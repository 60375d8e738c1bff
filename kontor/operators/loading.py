"""Loading only what is new, and the gates in front of a load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def insert_only_new(batch: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``.

    Nulls match nulls.  Rows are compared with the target only: a new key the
    batch holds twice stays twice.  A key the target holds often is reduced to
    one row before it is shuffled; a key the batch holds often is split by
    adaptive execution, which needs the distinct keys in an exchange of their
    own.
    """
    if existing is None:
        return batch
    types = _common_types(batch, existing, keys)
    known = existing.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in zip(keys, types, strict=True)]
    ).distinct()
    # Structs are equal where their fields are, nulls included.
    known = known.select(F.struct(*keys).alias("_key"))
    own = F.struct(*[
        batch[name].cast(kind).alias(name) for name, kind in zip(keys, types, strict=True)
    ])
    return batch.join(known, own == known["_key"], "left_anti")


def _common_types(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> list[T.DataType]:
    """Of each key the type both sides are compared in: of two numeric types the
    one that holds both, else the batch's."""
    found = []
    for name in keys:
        sides = [df.select(name).limit(0) for df in (batch, existing)]
        kinds = [side.schema[0].dataType for side in sides]
        numeric = all(isinstance(kind, T.NumericType) for kind in kinds)
        found.append(sides[0].union(sides[1]).schema[0].dataType if numeric else kinds[0])
    return found


def load_gate(
    target: DataFrame, saved: str = "saved", date: str = "orderdate"
) -> DataFrame:
    """One row: last load, last date, and whether the dates are ahead.

    The gate is open when either is missing.  It compares the target with
    itself; ``source_gate`` looks at the source.
    """
    last = target.agg(F.max(saved).alias("last_saved"), F.max(date).alias("last_date"))
    ahead = F.to_date("last_date") > F.to_date("last_saved")
    return last.withColumn("has_new", F.coalesce(ahead, F.lit(True)))


def has_new_fact_data(
    target: DataFrame | None, saved: str = "saved", date: str = "orderdate"
) -> bool:
    """Whether a fact load should run.  False when the target lacks a column."""
    if target is None:
        return True
    names = {name.lower() for name in target.columns}
    if saved.lower() not in names or date.lower() not in names:
        return False
    return load_gate(target, saved, date).first()["has_new"]


def source_gate(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """One row: newest value on both sides, and whether the source is ahead."""
    newest = source.agg(F.max(column).alias("source_latest"))
    loaded = target.agg(F.max(column).alias("target_latest"))
    both = newest.select("source_latest", loaded.scalar().alias("target_latest"))
    ahead = F.col("source_latest") > F.col("target_latest")
    fallback = F.col("source_latest").isNotNull() & F.col("target_latest").isNull()
    return both.withColumn("has_new", F.coalesce(ahead, fallback))


def source_is_newer(source: DataFrame, target: DataFrame, column: str) -> bool:
    return source_gate(source, target, column).first()["has_new"]


def needs_first_load(target: DataFrame | None) -> bool:
    """Whether the target has no row yet."""
    return target is None or target.isEmpty()


def stamp(df: DataFrame, load_date: dt.date | None = None, column: str = "saved") -> DataFrame:
    """Add the load date; today unless given."""
    day = F.current_date() if load_date is None else F.lit(load_date)
    return df.withColumn(column, day)
