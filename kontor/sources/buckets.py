"""Order headers and lines bucketed by order id, so that they meet without an exchange."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.operators.numbering import LARGE
from kontor.session import stored

HEADERS, LINES = "salesorderheader", "salesorderdetail"
KEY = "salesorderid"

#: What ``bucketed_source`` adds: rows in buckets, and lines that are in none.
IN_BUCKETS, APART = "_in_buckets", "_apart"


def write_bucketed(
    df: DataFrame, table: str, folder: str, key: str, buckets: int, limit: int | None = LARGE
) -> None:
    """Write a frame as two new tables of the catalog, ``<table>_in_buckets`` and ``<table>_apart``.

    A bucket is one file that one task reads, and adaptive execution cannot split it.  Rows
    whose key is null or has more than ``limit`` rows therefore go to the second table, which
    is not bucketed.  Such keys are at most one in ``limit`` rows, so they are broadcast.
    Without a limit, for a primary key, only nulls are apart.
    """
    few, apart = df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())
    if limit is not None:
        large = stored(
            few.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > limit).select("_key")
        )
        same = df[key] == large["_key"]
        apart = apart.unionByName(df.join(F.broadcast(large), same, "left_semi"))
        few = few.join(F.broadcast(large), same, "left_anti")
    (
        few.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        .option("path", f"{folder}/{table}{IN_BUCKETS}").saveAsTable(table + IN_BUCKETS)
    )
    apart.write.option("path", f"{folder}/{table}{APART}").saveAsTable(table + APART)


def write_orders(
    src: Mapping[str, DataFrame], folder: str, buckets: int, prefix: str = "", limit: int = LARGE
) -> None:
    """Headers and lines of orders in as many buckets each, below ``folder``.

    ``buckets`` should leave some hundred megabytes of lines in each.
    """
    write_bucketed(src[HEADERS], prefix + HEADERS, folder, KEY, buckets, None)
    write_bucketed(src[LINES], prefix + LINES, folder, KEY, buckets, limit)


def bucketed_source(
    spark: SparkSession, src: Mapping[str, DataFrame], prefix: str = ""
) -> Mapping[str, DataFrame]:
    """The source tables, with headers and lines from what ``write_orders`` has written.

    Under their own names both are whole; the facts join the parts one by one.
    """
    parts = {
        name + part: spark.table(prefix + name + part)
        for name in (HEADERS, LINES) for part in (IN_BUCKETS, APART)
    }
    whole = {name: parts[name + IN_BUCKETS].unionByName(parts[name + APART]) for name in (HEADERS, LINES)}
    return ChainMap({**parts, **whole}, src)


def headers_to_join(src: Mapping[str, DataFrame]) -> DataFrame:
    """The headers, those in buckets where there are any: others have no id that a line could meet."""
    return src.get(HEADERS + IN_BUCKETS, src[HEADERS])


def lines_to_join(src: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The lines in parts that share no order id; lines in buckets are one part, unmixed."""
    if LINES + IN_BUCKETS not in src:
        return [src[LINES]]
    apart = src[LINES + APART].filter(F.col(KEY).isNotNull())
    return [src[LINES + IN_BUCKETS], *([] if apart.isEmpty() else [apart])]
