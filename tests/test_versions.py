"""Versioned tables: commits, the key index, rejected rows and watermarks."""

import datetime as dt

import pytest
from helpers import SMALL, values
from pyspark.sql import functions as F

from kontor.operators.integrity import Constraints, checked
from kontor.operators.loading import insert_only_new
from kontor.plans import warehouse as jobs
from kontor.plans.warehouse import Warehouse
from kontor.sources import tables
from kontor.sources.versions import Conflict, Table, in_ranges, key_order, key_text


@pytest.fixture
def many_files(spark):
    """Ranges of keys stay files of their own, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_failed_replacement_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(100), path)
    reader = tables.read_table(spark, path)
    broken = spark.range(100).select(F.when(
        F.col("id") == 99, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half-way"):
        tables.replace_table(broken, path, probe=spark.range(1))
    assert tables.read_table(spark, path).count() == 100 == reader.count()
    # Those who read the version before go on, and a table may be made of itself.
    tables.replace_table(tables.read_table(spark, path).filter("id < 10"), path)
    assert tables.read_table(spark, path).count() == 10 and reader.count() == 100


def test_of_two_loads_at_once_one_is_refused(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    before = table.state()
    table.replace(spark.range(4))
    with pytest.raises(Conflict):
        table.commit(before, before)
    assert table.read().count() == 4


def test_old_versions_go(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    for n in range(1, 6):
        table.replace(spark.range(n))
    assert table.versions() == [4, 5] and table.read(4).count() == 4
    held = {p.name for p in (tmp_path / "t").glob("data-*/*/*.parquet")}
    assert held == {row["path"].split("/")[-1] for v in (4, 5) for row in table.files(table.state(v)).collect()}


def test_a_load_opens_only_files_that_may_hold_its_keys(spark, tmp_path, many_files):
    warehouse = Warehouse(spark, str(tmp_path))
    orders = spark.range(8000).select(F.col("id").alias("k"), F.lit("1998-01-01").alias("day"))
    assert warehouse.load("orders", orders, ["k"]) == 8000
    files = warehouse.table("orders").files().collect()
    assert len(files) > 4 and sum(row["rows"] for row in files) == 8000
    # One day's orders, all new: nothing is opened, and nothing written twice.
    day = spark.range(8000, 8100).select(F.col("id").alias("k"), F.lit("1998-01-02").alias("day"))
    assert warehouse.load("orders", day, ["k"]) == 100
    assert warehouse.loads["orders"].opened == 0 and warehouse.loads["orders"].files == len(files)
    # New orders with an old one whose date has changed: one file may hold it.
    more = spark.range(8100, 8200).union(spark.range(4000, 4001)).select(
        F.col("id").alias("k"), F.lit("1998-01-03").alias("day"))
    assert warehouse.load("orders", more, ["k"]) == 100
    assert warehouse.loads["orders"].opened == 1
    found = {row["k"]: row["day"] for row in warehouse["orders"].collect()}
    assert len(found) == 8200 and found[4000] == "1998-01-01" and found[8150] == "1998-01-03"
    before = {p.name for p in (tmp_path / "orders").glob("data-*/*/*.parquet")}
    assert warehouse.load("orders", more, ["k"]) == 0
    assert warehouse.table("orders").versions()[-1] == 3 and warehouse["orders"].count() == 8200
    listed = {row["path"].split("/")[-1] for row in warehouse.table("orders").files().collect()}
    assert listed <= before


def test_negative_null_and_text_keys_are_found(spark, frame, tmp_path, many_files):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = frame([(n, "x") for n in range(-50, 50)] + [(None, "y")], "k BIGINT, v STRING")
    assert warehouse.load("n", rows, ["k"]) == 101
    assert warehouse.load("n", rows.union(frame([(-51, "z"), (9**18, "z")], "k BIGINT, v STRING")), ["k"]) == 2
    texts = frame([(f"SO{n}", n) for n in range(90)] + [(None, 1)], "k STRING, v INT")
    assert warehouse.load("t", texts, ["k", "v"]) == 91
    assert warehouse.load("t", texts.withColumn("v", F.col("v") + F.when(F.col("k") == "SO7", 1).otherwise(0)), ["k", "v"]) == 1


def test_columns_of_the_table_count(spark, frame, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.load("t", frame([(1, "a")], "k BIGINT, v STRING"), ["k"])
    warehouse.load("t", frame([("b", 2)], "v STRING, k INT"), ["k"])
    warehouse.load("t", frame([(3,)], "k INT"), ["k"])
    assert values(warehouse["t"]) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="no columns"):
        warehouse.load("t", frame([(4, 1)], "k INT, other INT"), ["k"])


def test_rejected_rows(spark, frame, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.load("dims", frame([(1,), (2,)], "d INT"), ["d"])
    rules = Constraints(not_null=["v"], unique=["k"], references={"d": ("dims", "d")})
    batch = frame([(1, "a", 1), (1, "a", 1), (1, "b", 9), (2, None, 3), (3, "c", None), (None, "n", 1), (None, "n", 2)],
                  "k INT, v STRING, d INT")
    assert warehouse.load("facts", batch, ["k"], rules) == 3
    assert values(warehouse["facts"]) == [(None, "n", 1), (1, "a", 1), (3, "c", None)]
    assert warehouse.loads["facts"].rejected == 4
    bad = sorted((row.k or 0, tuple(row.reasons)) for row in warehouse.rejected("facts").collect())
    assert bad == [(0, ("repeated: k",)), (1, ("repeated: k",)), (1, ("repeated: k", "missing: d")),
                   (2, ("null: v", "missing: d"))]
    # All rows of a load may be bad; the table stays as it is and the rows are kept.
    assert warehouse.load("facts", frame([(7, None, 1)], "k INT, v STRING, d INT"), ["k"], rules) == 0
    assert warehouse["facts"].count() == 3 and warehouse.rejected("facts").count() == 5


def test_one_key_of_most_rows_is_rejected_but_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert warehouse.load("t", rows, ["k"], Constraints(unique=["k"])) == 101
    assert warehouse.rejected("t").count() == 2899


def test_loads_since_the_watermark(spark, frame, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows = [(n, f"2020-01-{n:02d}") for n in range(1, 21)]
    layout = "k INT, changed STRING"
    source = frame(rows, layout).withColumn("changed", F.col("changed").cast("timestamp_ntz"))
    early = source.filter("k <= 7")
    assert warehouse.load_since("t", "erp", early, "changed", keys=["k"]) == 7
    assert warehouse.load_since("t", "erp", early, "changed", keys=["k"]) == 0
    broken = source.withColumn("k", F.when(F.col("k") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("k")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        warehouse.load_since("t", "erp", broken, "changed", keys=["k"])
    assert warehouse.watermark("t", "erp").startswith("2020-01-07")
    assert warehouse.load_since("t", "erp", source, "changed", keys=["k"]) == 13
    assert warehouse.load_since("t", "erp", source.limit(0), "changed", keys=["k"]) == 0
    assert warehouse.watermark("t", "erp").startswith("2020-01-20") and warehouse["t"].count() == 20
    assert warehouse.watermark("t", "other") is None


@pytest.mark.parametrize("limit", [0, 3, 1 << 20])
def test_repeated_keys_of_any_size(frame, limit):
    rows = [(1, "b", 0.0), (1, "a", 1.0), (1, "a", 1.0), (1, None, 2.0), (1, "c", 1.0), (None, "x", 1.0),
            (None, "x", 1.0), (None, "w", None), (2, "z", -0.0), (2, "z", 0.0), (3, "q", float("nan"))]
    batch = frame(rows, "k INT, v STRING, d DOUBLE")
    found = checked(batch, Constraints(unique=["k"]), {}, limit)
    good = [tuple(row)[:2] for row in found.filter(F.size("reasons") == 0).collect()]
    assert sorted(good, key=str) == [(1, None), (2, "z"), (3, "q"), (None, "w")]
    assert {tuple(row.reasons) for row in found.collect()} == {(), ("repeated: k",)}
    shown = ["k", "v", "CAST(d + 0.0 AS STRING) AS d"]
    assert values(found.selectExpr(*shown)) == values(batch.selectExpr(*shown))


def test_rows_under_constraints_are_exchanged_once(spark):
    """From the scan to the files: they are sorted where their keys have met."""
    batch = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    rules = Constraints(unique=["l_orderkey", "l_linenumber"], not_null=["l_quantity"])
    found = checked(batch, rules, {})
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    placed = checked(batch, rules, {}, place=lambda rows: in_ranges(rows, "l_orderkey"))
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "rangepartitioning" in text
    assert values(found, "l_orderkey", "l_linenumber", "reasons") == values(
        placed, "l_orderkey", "l_linenumber", "reasons")


def test_keys_sort_as_their_text(frame):
    for kind, held in (("BIGINT", [5, -3, None, 1 << 62, 10, -20]), ("STRING", ["b", None, "B", "\u00e4", "a"]),
                       ("DATE", [None, dt.date(2020, 1, 1), dt.date(1999, 1, 1)])):
        df = frame([(value,) for value in held], f"k {kind}")
        text, order = (way("k", df.schema["k"].dataType) for way in (key_text, key_order))
        assert [r.k for r in df.sort(order).collect()] == [r.k for r in df.sort(text).collect()]
        if kind != "DATE":
            assert "lpad" not in str(order) and "CAST" not in str(order).upper()


def test_known_rows_are_told_in_the_ranges_that_are_written(frame):
    """As the join tells them, nulls included, but with one exchange of the rows."""
    batch = frame([("a", 1, 5.0), ("a", 1, 6.0), ("a", 2, 1.0), (None, 1, 1.0), (None, None, 2.0), ("b", None, 3.0),
                   ("c", 1, 1.0), ("c", 1, 1.0)], "k STRING, n INT, v DOUBLE")
    existing = frame([("a", 1, 0.0), ("a", 1, 0.0), (None, None, 0.0), ("c", 2, 1.0)], "k STRING, n INT, v DOUBLE")
    found = jobs._new_in_ranges(batch, existing, ["k", "n"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "rangepartitioning" in text
    assert values(found) == values(insert_only_new(batch, existing, ["k", "n"]))
    assert found.count() == 5
