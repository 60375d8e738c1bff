"""Compare every query with its SQL on the same tables.

Usage: python -m workload.compare FOLDER [QUERY ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from workload import queries
from workload.oracle import oracle_sql

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
            )
    return connection


def _value(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", str(value))
    if isinstance(value, (int, float)):
        return ("number", repr(float(value)))
    return (type(value).__name__, str(value))


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, connection, sql: str) -> str | None:
    """What differs, or None."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(set(names) ^ set(result.columns))}"
    wanted, found = _rows(names, expected.fetchall()), _rows(result.columns, result.collect())
    if len(wanted) != len(found):
        return f"{len(found)} rows instead of {len(wanted)}"
    for left, right in zip(found, wanted):
        if left != right:
            return f"{left}\n  instead of {right}"
    return None


def main(folder: str, *names: str) -> int:
    from kontor.session import local_session

    spark: SparkSession = local_session("8")
    connection = database(folder)
    texts = oracle_sql()
    failed = 0
    for name in names or queries.QUERIES:
        start = time.perf_counter()
        try:
            found = queries.run(name, spark, folder)
            problem = difference(found, connection, texts[name]) if name in texts else "no SQL"
        except Exception as error:  # noqa: BLE001 - reported, and the next query runs
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.2f}s", problem or "", flush=True)
    print(f"{failed} failed", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
