"""Reading source tables and writing results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kontor.sources.versions import Table

# Rows per statement when writing to a database.
BATCH_ROWS = 5000


def load_tables(
    spark: SparkSession, names: Iterable[str], folder: str | None = None
) -> dict[str, DataFrame]:
    """Tables by name, from Parquet under ``folder`` or from the catalog."""
    if folder is None:
        return {name: spark.table(name) for name in names}
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def jdbc_read_options(
    url: str, table: str, column: str | None = None, bounds: tuple | None = None,
    partitions: int = 1, properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a database scan, split over ``column`` where one is given.

    Without a column the whole table passes through one task.
    """
    options = {**(properties or {}), "url": url, "dbtable": table}
    if column is not None:
        low, high = bounds
        options.update({
            "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(partitions),
        })
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **options)).load()


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None
) -> None:
    """Append to a database table; atomic per partition, not per load."""
    df.write.format("jdbc").options(
        **(properties or {}), url=url, dbtable=table, batchsize=str(BATCH_ROWS)
    ).mode("append").save()


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is known once it has been written."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def append(df: DataFrame, path: str) -> int:
    """Append to a folder of Parquet files; returns the number of rows."""
    observed, rows = counted(df)
    observed.write.mode("append").parquet(path)
    return rows.get["rows"]


def replace_table(df: DataFrame, path: str, probe: DataFrame | None = None) -> int:
    """Replace a table as one commit; an empty result leaves it as it is.

    ``probe`` is a cheap frame that is empty exactly when ``df`` is, such as
    the scan ``df`` is made of.  ``read_table`` reads the version before until the
    new one is complete; ``df`` may read it too.
    """
    if (df if probe is None else probe).isEmpty():
        return 0
    return Table(df.sparkSession, path).replace(df)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed version of a table that ``replace_table`` has written."""
    found = Table(spark, path).read()
    if found is None:
        raise FileNotFoundError(path)
    return found


def export_csv(df: DataFrame, name: str, folder: str = "./output", sep: str = ",") -> str:
    """Write ``<folder>/<name>.csv`` with header, in UTF-8.

    The result is a folder of part files, one per task.
    """
    path = f"{folder}/{name if name.endswith('.csv') else name + '.csv'}"
    df.write.mode("overwrite").options(
        header="true", sep=sep, encoding="UTF-8", escape='"'
    ).csv(path)
    return path
