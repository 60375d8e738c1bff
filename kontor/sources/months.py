"""Facts laid out by month, so that reports of a period read only its months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Year and month of the order, as 199704; the column whose values are folders.
MONTH = "ordermonth"


def month_of(key: str):
    """The month of a date key; null stays null."""
    return F.floor(F.col(key) / 100).cast("int")


def write_by_month(fact: DataFrame, path: str, key: str = "orderdatekey") -> None:
    """Write a fact to a new folder, one folder a month.

    Rows go to ranges of (month, day, hash of the row), so a day of many rows is spread over
    several tasks, and most tasks write to one month or two.  Rows without a date have a folder of their own.
    """
    order = [F.col(MONTH), F.col(key), F.xxhash64(*fact.columns)]
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        fact.withColumn(MONTH, month_of(key))
        .repartitionByRange(tasks, *order).sortWithinPartitions(MONTH, key)
        .write.partitionBy(MONTH).parquet(path)
    )


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The fact with its month; ``schema`` is that of the fact."""
    return spark.read.schema(T.StructType([*schema, T.StructField(MONTH, T.IntegerType())])).parquet(path)
