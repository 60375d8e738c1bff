"""Parquet tables whose readers see one committed version.

A table is a folder of immutable data files and a list of versions.  A version is a small
JSON file that names its lists; a list is a Parquet table with one row per data file: path,
rows, and the least and largest key in it, the table's key index.  A commit writes the next
version under a name of its own and renames it, which fails where that version exists.  So
readers have the version before or the one after, a load that fails half-way leaves only
files nobody lists, and of two loads at once one is refused.

``low`` and ``high`` are keys as text in an order of their own (``key_text``).
"""

from __future__ import annotations

import bisect
import json
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIST = "path STRING, rows BIGINT, low STRING, high STRING"
_ACCEPTED, _REJECTED = "rejected=false", "rejected=true"


class Conflict(RuntimeError):
    """Another load has committed the version this one wanted to."""


def key_text(name: str, kind: T.DataType) -> Column:
    """A key as text; whole numbers keep their order.  Null is the empty text."""
    key = F.col(name)
    if isinstance(kind, T.IntegralType):
        key = F.lpad((key.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.coalesce(key.cast("string"), F.lit(""))


def sorts_as_text(kind: T.DataType) -> bool:
    """Whether keys of this type sort as their text does."""
    return isinstance(kind, T.IntegralType) or kind == T.StringType()


def key_order(name: str, kind: T.DataType) -> Column:
    """What sorts as the text of a key does: the key itself where it can, which is no work to compare."""
    return F.col(name).asc_nulls_first() if sorts_as_text(kind) else key_text(name, kind)


def in_ranges(df: DataFrame, key: str) -> DataFrame:
    """The rows in partitions that hold ranges of the key."""
    return df.repartitionByRange(key_order(key, df.schema[key].dataType))


class Table:
    """One versioned table."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # Versions.

    def _place(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _system(self):
        return self._place("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        system, place = self._system(), self._place("_versions")
        if not system.exists(place):
            return []
        names = [status.getPath().getName() for status in system.listStatus(place)]
        return sorted(int(name[:-5]) for name in names if name[:-5].isdigit() and name.endswith(".json"))

    def state(self, version: int | None = None) -> dict | None:
        """What a version holds, by default the last one; None before the first."""
        if version is None:
            version = max(self.versions(), default=None)
            if version is None:
                return None
        text = self.spark.read.text(f"{self.path}/_versions/{version:010d}.json", wholetext=True)
        return json.loads(text.first()[0]) | {"version": version}

    def commit(self, before: dict | None, after: dict) -> int:
        """Make ``after`` the version behind ``before``; raises ``Conflict`` if there is one."""
        version = (before["version"] if before else 0) + 1
        jvm, system = self.spark._jvm, self._system()
        held, name = self._place(f"_versions/.{uuid.uuid4().hex}"), self._place(f"_versions/{version:010d}.json")
        stream = system.create(held, False)
        stream.write(bytearray(json.dumps(after | {"version": version}).encode()))
        stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            held.toUri(), self.spark._jsc.hadoopConfiguration()
        ) if held.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.spark._jsc.hadoopConfiguration()
        )
        none = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(held, name, none)
        except Exception as error:
            system.delete(held, False)
            if system.exists(name):
                raise Conflict(f"version {version} of {self.path} exists") from error
            raise
        return version

    def vacuum(self, keep: int = 2) -> int:
        """Delete what only versions before the last ``keep`` list; returns files deleted."""
        numbers, system = self.versions(), self._system()
        old, kept = numbers[:-keep], [self.state(number) for number in numbers[-keep:]]
        listed = {name for state in kept for name in state["lists"] + state["rejects"]}
        files = {row["path"] for row in self._listed(listed).collect()}
        gone = 0
        for state in map(self.state, old):
            for name in set(state["lists"] + state["rejects"]) - listed:
                for row in self._listed([name]).collect():
                    if row["path"] not in files:
                        gone += bool(system.delete(self._place(row["path"]), False))
                system.delete(self._place(name), True)
            system.delete(self._place(f"_versions/{state['version']:010d}.json"), False)
        return gone

    # Reading.

    def _listed(self, names) -> DataFrame:
        paths = [f"{self.path}/{name}" for name in names]
        if not paths:
            return self.spark.createDataFrame([], _LIST)
        return self.spark.read.schema(_LIST).parquet(*paths)

    def files(self, state: dict | None = None) -> DataFrame:
        """The data files of a version with their keys."""
        state = state or self.state()
        return self._listed(state["lists"] if state else [])

    def rows_of(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{path}" for path in paths])

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default the last; None before the first."""
        state = self.state(version)
        if state is None:
            return None
        paths = [row["path"] for row in self.files(state).collect()]
        return self.rows_of(paths, T.StructType.fromJson(state["schema"]))

    def rejected(self, version: int | None = None) -> DataFrame | None:
        """The rows that broke a constraint, with ``reasons``."""
        state = self.state(version)
        if state is None:
            return None
        schema = T.StructType.fromJson(state["schema"]).add("reasons", T.ArrayType(T.StringType()))
        return self.rows_of([row["path"] for row in self._listed(state["rejects"]).collect()], schema)

    # Writing.

    def stage(
        self, df: DataFrame, key: str | None = None, sort: bool = True, spread: bool = True
    ) -> tuple[str, list, list]:
        """Write rows; returns the folder, its data files and its files of rejects.

        A column ``reasons`` says why a row is rejected; empty where it isn't.  Rows are sorted by
        ``key``, so that files hold ranges of keys; rows that lie in such ranges need no ``spread``.
        """
        folder = f"data-{uuid.uuid4().hex}"
        reasoned = "reasons" in df.columns
        bad = F.size("reasons") > 0 if reasoned else F.lit(False)
        rows = df.withColumn("rejected", bad)
        if key is not None and sort:
            rows = in_ranges(rows, key) if spread else rows
            rows = rows.sortWithinPartitions("rejected", key_order(key, df.schema[key].dataType))
        rows.write.partitionBy("rejected").parquet(f"{self.path}/{folder}")
        return (folder, *[self._indexed(f"{folder}/{part}", df.schema, key) for part in (_ACCEPTED, _REJECTED)])

    def _indexed(self, folder: str, schema: T.StructType, key: str | None) -> list:
        """One row per file: path, rows, least and largest key.  Reads the key column."""
        if not self._system().exists(self._place(folder)):
            return []
        text = F.lit(None).cast("string") if key is None else key_text(key, schema[key].dataType)
        found = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}").select(
            F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")).alias("path"), text.alias("key")
        )
        return found.groupBy("path").agg(
            F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
        ).collect()

    def listed(self, rows: Sequence) -> list[str]:
        """Write a list of data files; returns its name in a list, or nothing for none."""
        if not rows:
            return []
        name = f"list-{uuid.uuid4().hex}"
        self.spark.createDataFrame([tuple(row) for row in rows], _LIST).coalesce(1).write.parquet(
            f"{self.path}/{name}")
        return [name]

    def drop(self, folder: str) -> None:
        self._system().delete(self._place(folder), True)

    def hits(self, staged: Sequence, existing: Sequence, key: str, schema: T.StructType) -> dict[str, set[str]]:
        """For each staged file the existing ones that may hold one of its keys.

        Files whose ranges are apart aren't opened; of the others the staged keys are compared
        with the ranges, so a file counts only if a key falls into it.
        """
        ranges = sorted(((row["low"], row["high"], row["path"]) for row in existing))
        lows = [low for low, _, _ in ranges]
        near = [row["path"] for row in staged
                if any(high >= row["low"] for _, high, _ in ranges[:bisect.bisect_right(lows, row["high"])])]
        if not near:
            return {}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = set()
                for path in batch["path"].unique().to_pylist():
                    own = pa.compute.equal(batch["path"], path)
                    keys = sorted(batch["key"].filter(own).unique().to_pylist())
                    for low, high, other in ranges[:bisect.bisect_right(lows, keys[-1])]:
                        at = bisect.bisect_left(keys, low)
                        if at < len(keys) and keys[at] <= high:
                            found.add((path, other))
                if found:
                    yield pa.RecordBatch.from_pylist([{"path": a, "other": b} for a, b in sorted(found)])

        rows = self.rows_of(near, schema).select(
            F.col("_metadata.file_path").alias("path"), key_text(key, schema[key].dataType).alias("key"))
        pairs = rows.mapInArrow(run, "path STRING, other STRING").distinct().collect()
        out: dict[str, set[str]] = {}
        for name in near:
            for pair in pairs:
                if pair["path"].endswith(name):
                    out.setdefault(name, set()).add(pair["other"])
        return out

    def replace(self, df: DataFrame) -> int:
        """Make ``df`` the whole table; readers of the version before are not disturbed."""
        before = self.state()
        _, files, _ = self.stage(df)
        self.commit(before, {
            "schema": json.loads(df.schema.json()), "lists": self.listed(files), "rejects": [], "watermarks": {},
        })
        self.vacuum()
        return sum(row["rows"] for row in files)
