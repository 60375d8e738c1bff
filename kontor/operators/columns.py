"""Column-level operators: layout, defaults, tolerant name lookup."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, layout: str) -> DataFrame:
    """Columns of ``layout`` (a DDL text) in its order and types.

    A column ``df`` lacks becomes null.
    """
    present = {name.lower() for name in df.columns}
    return df.selectExpr(*[
        f"CAST({f'`{field.name}`' if field.name.lower() in present else 'NULL'} "
        f"AS {field.dataType.simpleString()}) AS `{field.name}`"
        for field in T.StructType.fromDDL(layout)
    ])


def choose_column(df: DataFrame, candidates: Iterable[str]) -> str:
    """First candidate ``df`` has, in any case; else its first column."""
    actual = {name.lower(): name for name in df.columns}
    for candidate in candidates:
        if candidate.lower() in actual:
            return actual[candidate.lower()]
    return df.columns[0]


def find_column(df: DataFrame, name: str) -> Column | None:
    """The column called ``name`` in any case, or None."""
    actual = {column.lower(): column for column in df.columns}
    return F.col(actual[name.lower()]) if name.lower() in actual else None


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in the floating point columns."""
    floats = {
        field.name: F.when(~F.isnan(field.name), F.col(field.name))
        for field in df.schema
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def copy_columns(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """Add ``new`` as a copy of ``old`` for each ``new: old``."""
    return df.withColumns({new: F.col(old) for new, old in copies.items()})


def since(df: DataFrame, moment=None, column: str = "modifieddate") -> DataFrame:
    """Rows changed at or after ``moment``; all rows when it is None.

    A date or time is read in the type of the column, whatever the time zones
    of the session and the machine.
    """
    if moment is None:
        return df
    return df.filter(F.col(column) >= F.lit(str(moment)).cast(df.schema[column].dataType))


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add costly named expressions so that each is evaluated once per row.

    Results of a generator are neither repeated in later expressions nor
    pushed into filters, as those of a projection may be.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))
