"""Parent-child dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.operators.numbering import assign_keys


def with_root(df: DataFrame, name: str, root: str, key: str, parent: str) -> DataFrame:
    """Put one root above all rows: key 1, the others numbered by name."""
    top = df.sparkSession.range(1).select(F.lit(root).alias(name))
    members = top.unionByName(df, allowMissingColumns=True)
    is_root = F.col(name).eqNullSafe(F.lit(root))
    keyed = assign_keys(members, [is_root.desc(), F.col(name).asc_nulls_last()], key)
    return keyed.withColumn(parent, F.when(~is_root, F.lit(1).cast("bigint")))


def parent_key(
    df: DataFrame, parent_code: str, code: str, key: str, out: str
) -> DataFrame:
    """Key of the row of the same table whose ``code`` is ``parent_code``."""
    parents = df.select(F.col(code).alias("_code"), F.col(key).alias(out))
    return df.join(parents, df[parent_code] == parents["_code"], "left").select(
        *[df[name] for name in df.columns], parents[out]
    )


def division_tree(territories: DataFrame, name: str, key: str, parent: str) -> DataFrame:
    """A ``<name> Division`` parent for each row, and the row as its child.

    Parents are numbered from 1, children follow behind the last parent in the
    same order.
    """
    order = [F.col(column).asc_nulls_last() for column in (name, *territories.columns)]
    divisions = assign_keys(territories, order, key)
    last = divisions.agg(F.max(key)).scalar()
    children = divisions.select(
        (F.col(key) + last).alias(key), F.col(key).alias(parent),
        *[F.col(column) for column in territories.columns],
    )
    parents = divisions.select(
        key, F.lit(None).cast("bigint").alias(parent),
        *[
            F.concat(F.col(column), F.lit(" Division")).alias(column)
            if column == name else F.col(column)
            for column in territories.columns
        ],
    )
    return parents.withColumn("is_division", F.lit(True)).unionByName(
        children.withColumn("is_division", F.lit(False))
    )
