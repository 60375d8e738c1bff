"""Session settings the jobs rely on, and durable intermediate results."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What ``stored`` has written inside a ``discarding`` block, per thread.
_scopes = threading.local()

# Runtime settings.  Skewed join partitions are split even where that costs a
# further exchange: one key may hold a third of all rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kontor")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{tempfile.gettempdir()}/kontor"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and read it from there.

    Needed where a result depends on how rows were partitioned: a recomputed
    partition could otherwise differ from the one already used.  Later steps
    read only the columns they use.  ``discard_stored`` removes what one
    application has written.
    """
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    for scope in getattr(_scopes, "open", [])[-1:]:
        scope.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Remove what ``stored`` writes inside: for jobs that end in a written table."""
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            _remove(spark, path)


def discard_stored(spark: SparkSession) -> None:
    """Remove the results ``stored`` has written for this application."""
    _remove(spark, application_folder(spark))


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def application_folder(spark: SparkSession) -> str:
    """Where this application keeps intermediate results."""
    return f"{shared_folder(spark)}/kontor-{spark.sparkContext.applicationId}"
