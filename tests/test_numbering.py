"""Keys and line numbers, in one task and across tasks."""

from collections import Counter

import pytest
from helpers import SMALL, values
from pyspark.sql import functions as F

from kontor.operators import numbering


def lines(frame, groups):
    rows = [(key, n % 7, n) for key, size in groups.items() for n in range(size)]
    return frame(rows, "k STRING, a INT, b INT")


def expected_numbers(rows, key, order):
    out = {}
    for value in {key(row) for row in rows}:
        for n, row in enumerate(sorted((r for r in rows if key(r) == value), key=order), 1):
            out[tuple(row)] = n
    return out


@pytest.mark.parametrize("limit", [0, 50, 1 << 20])
def test_line_number_with_large_groups(frame, limit):
    df = lines(frame, {"hot": 400, "warm": 60, "cold": 3, "single": 1})
    found = numbering.line_number(df, ["k"], ["a", "b"], "line", limit=limit)
    rows = [tuple(row) for row in df.collect()]
    expected = expected_numbers(rows, lambda r: r[0], lambda r: (r[1], r[2]))
    assert {tuple(row)[:3]: row.line for row in found.collect()} == expected
    assert found.schema["line"].dataType.simpleString() == "int"


def test_large_groups_by_given_sizes(frame):
    df = lines(frame, {"hot": 400, "warm": 60})
    sizes = frame([("hot", 300), ("hot", 100), ("warm", 60), (None, 9)], "k STRING, rows BIGINT")
    found = numbering.line_number(df, ["k"], ["a", "b"], "line", sizes, limit=100)
    assert values(found) == values(numbering.line_number(df, ["k"], ["a", "b"], "line"))


def test_a_large_group_is_numbered_by_many_tasks(spark, frame):
    df = lines(frame, {"hot": 7000})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = numbering.line_number(df, ["k"], ["a", "b"], "line", limit=1000)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 7000


def test_lines_are_exchanged_once(spark):
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    order = [name for name in lineitem.columns if name != "l_orderkey"]
    text = numbering.line_number(lineitem, ["l_orderkey"], order, "line")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_both_ways_give_null_keys_no_number(frame):
    df = frame([("a", 1, 1), ("a", 2, 1), (None, 2, 2), (None, 2, 3), ("a", None, 4)], "k STRING, l INT, v INT")
    for keys in (["k"], ["k", "l"]):
        order = [name for name in df.columns if name not in keys]
        one = numbering.line_number(df, keys, order, "line")
        two = numbering.number_within(df, keys, [F.col(n).asc_nulls_last() for n in order], "line")
        assert values(one) == values(two)
        assert {row.line for row in one.collect() if row.k is None} == {None}


def test_line_number_of_a_null_key_is_null(frame):
    df = frame([("a", 1), (None, 2), (None, 3)], "k STRING, v INT")
    found = numbering.line_number(df, ["k"], ["v"], "line")
    assert values(found, "v", "line") == [(1, 1), (2, None), (3, None)]


def test_equal_rows_are_numbered_one_by_one(frame):
    df = frame([("hot", 1)] * 300 + [("hot", 0)] * 20 + [("b", 5)], "k STRING, v INT")
    found = numbering.number_within(df, ["k"], ["v"], "line").collect()
    assert sorted(row.line for row in found if row.k == "hot") == list(range(1, 321))
    assert {row.v for row in found if row.k == "hot" and row.line <= 20} == {0}
    assert [row.line for row in found if row.k == "b"] == [1]


def test_number_within_null_group(frame):
    df = frame([(None, 2), (None, 1), ("a", 3)], "k STRING, v INT")
    found = numbering.number_within(df, ["k"], ["v"], "line")
    assert values(found, "v", "line") == [(1, None), (2, None), (3, 1)]


def test_assign_keys_is_the_global_row_number(frame):
    df = frame([(i % 50, (i * 7919) % 1000) for i in range(1000)], "a INT, b INT")
    found = numbering.assign_keys(df, [F.col("a").desc()], "key", start=11).collect()
    wanted = sorted(((i % 50, (i * 7919) % 1000) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert [(row.a, row.b) for row in sorted(found, key=lambda row: row.key)] == wanted
    assert sorted(row.key for row in found) == list(range(11, 1011))


def test_assign_keys_of_nothing(frame):
    assert numbering.assign_keys(frame([], "a INT"), [F.col("a")], "key").count() == 0


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_expand_copies(frame, limit):
    df = frame([("a", 23), ("b", 1), ("c", 7), ("none", 0)], "k STRING, n BIGINT")
    found = numbering.expand_copies(df, "n", "copy", limit).collect()
    assert Counter(row.k for row in found) == {"a": 23, "b": 1, "c": 7}
    assert sorted(row.copy for row in found if row.k == "a") == list(range(1, 24))


def test_ranges_of_copies_stay_spread(frame):
    """Adaptive execution must not put the few, small ranges into one task."""
    found = numbering.expand_copies(frame([("hot", 64_000)], "k STRING, n BIGINT"), "n", "copy", 1000)
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 4 and max(row["count"] for row in tasks) < 32_000


def test_large_group_is_cut_into_slices(frame):
    """A group of all rows is placed by several tasks."""
    df = frame([("hot", n) for n in range(8000)], "k STRING, v INT")
    found = numbering.number_within(df, ["k"], ["v"], "line")
    placed = numbering.number_rows(df, ["k", "v"], "n")
    assert placed.select(F.spark_partition_id()).distinct().count() > 4
    assert found.filter("line <> v + 1").isEmpty()


def test_surrogate_keys_survive_a_second_action(frame):
    """The keyed rows are stored: reading them again gives the same keys."""
    df = frame([(i % 10,) for i in range(500)], "a INT")
    keyed = numbering.assign_keys(df, [F.col("a")], "key")
    assert values(keyed) == values(keyed)


def test_large_groups_meet_their_first_number_without_an_exchange(spark, frame):
    """One row a group is broadcast, whatever Spark takes its size for."""
    df = frame([(n % 3, n) for n in range(900)], "k INT, v INT")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = numbering.number_within(df, ["k"], ["v"], "line")
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(k#" not in text
        assert found.filter("line <> v DIV 3 + 1").isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
