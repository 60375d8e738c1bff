"""Operators of the reports: pivots, top lists, shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_report(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    value: str,
    values: Sequence | None = None,
    agg: str = "avg",
    fill=None,
) -> DataFrame:
    """One column per value of ``column``, rows in the order of ``index``.

    Give ``values`` where they are known: Spark otherwise reads the input once
    more to find them, and refuses more than ``spark.sql.pivotMaxValues``.
    """
    grouped = df.groupBy(*index)
    pivoted = grouped.pivot(column) if values is None else grouped.pivot(column, list(values))
    wide = pivoted.agg({value: agg})
    if fill is not None:
        wide = wide.na.fill(fill, [name for name in wide.columns if name not in index])
    return wide.orderBy(*[F.col(name).asc_nulls_last() for name in index])


def top_n(df: DataFrame, by: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the largest value; ``ties`` decide between equals."""
    return df.orderBy(
        F.col(by).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in ties]
    ).limit(n)


def share_of_total(df: DataFrame, value: str, out: str = "share") -> DataFrame:
    """Percentage of the total, to one decimal."""
    total = df.agg(F.sum(value)).scalar()
    share = F.col(value).cast("double") * 100 / F.nullif(total.cast("double"), F.lit(0.0))
    return df.withColumn(out, F.round(share, 1))
