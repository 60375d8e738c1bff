"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence | None = None
) -> DataFrame:
    """First row of each key; null keys form one key.

    ``order`` defaults to all other columns, nulls last, which makes the
    choice independent of how rows are stored.  Spark applies the limit of one
    row per key before the shuffle as well, so a hot key sends at most one row
    per task.
    """
    if order is None:
        order = [F.col(name).asc_nulls_last() for name in df.columns if name not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*(order or keys))
    return (
        df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], changed: str) -> DataFrame:
    """Most recently changed row of each key."""
    rest = [F.col(name).asc_nulls_last() for name in df.columns if name not in (*keys, changed)]
    return first_per_key(df, keys, [F.col(changed).desc_nulls_last(), *rest])
