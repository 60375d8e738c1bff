"""Every query against its SQL, and the shape of some plans."""

import pytest
from helpers import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kontor.sources.retail import GIVEN_TABLES
from workload import queries
from workload.compare import database, difference


@pytest.fixture(scope="module")
def connection():
    return database(SMALL)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, connection, name):
    result = entry.queries()[name](spark, SMALL)
    assert difference(result, connection, entry.oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(queries.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unbroadcast(spark):
    """Dimensions that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_python_is_for_surveys_only(spark):
    for name in ("fact_internet_sales", "dim_product", "dim_employee", "store_quarter_pivot", "dim_date"):
        text = plan(queries.run(name, spark, SMALL))
        assert "Python" not in text and "Pandas" not in text, name


def test_small_dimensions_are_broadcast(spark):
    text = plan(queries.run("sales_by_quarter_region", spark, SMALL))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_changed_orders_cut_the_lines_first(spark, unbroadcast):
    """The join next to the scan of lines is the one with the changed orders."""
    for name in ("fact_internet_sales_since", "fact_reseller_sales_since"):
        lines = plan(queries.run(name, spark, SMALL)).splitlines()
        scans = [i for i, line in enumerate(lines) if "lineitem.parquet" in line]
        assert scans
        for scan in scans:
            joins = [line for line in lines[:scan] if "Join" in line]
            assert "LeftSemi" in joins[-1] and "salesorderid" in joins[-1], name


def test_orders_and_regions_beyond_the_given_ones(spark, tmp_path):
    """An order in 2004 and a sixth region are in the reports."""
    for name in GIVEN_TABLES:
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "region":
            table = table.union(table.filter("r_regionkey = 0").selectExpr("5", "'ATLANTIS'").select(
                F.col("5").cast(table.schema[0].dataType), "ATLANTIS"))
        if name == "nation":
            table = table.withColumn("n_regionkey", F.when(F.col("n_nationkey") == 7, F.lit(5)).otherwise(
                F.col("n_regionkey")).cast(table.schema["n_regionkey"].dataType))
        if name == "orders":
            late = F.expr("timestamp_ntz'2004-02-29 00:00:00'").cast(table.schema["o_orderdate"].dataType)
            table = table.withColumn("o_orderdate", F.when(F.col("o_orderkey") < 40, late).otherwise(
                F.col("o_orderdate")))
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    folder = str(tmp_path)
    pivot = queries.run("sales_pivot_region", spark, folder)
    assert "ATLANTIS" in pivot.columns and pivot.filter("ATLANTIS > 0").count() > 0
    for name in ("sales_by_quarter_region", "sales_by_month", "store_sales_month"):
        assert queries.run(name, spark, folder).filter("`año` = 2004").count() > 0, name



def test_first_per_key_limits_before_the_shuffle(spark):
    text = plan(queries.run("datamart_dim_employee", spark, SMALL))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_skewed_load_keys_can_be_split(spark, unbroadcast):
    """Both sides of the join are sorted exchanges, as skew handling needs."""
    lines = plan(queries.run("insert_only_new", spark, SMALL)).splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert "Sort [" in lines[join + 1] and "Exchange hashpartitioning" in lines[join + 2]
    right = next(i for i in range(join + 3, len(lines)) if "+- Sort [" in lines[i])
    assert "Exchange hashpartitioning" in lines[right + 1]


def test_only_needed_columns_are_read(spark):
    text = plan(queries.run("sales_by_month", spark, SMALL))
    assert "l_comment" not in text and "l_tax" not in text and "c_name" not in text


def test_incremental_scan_is_pushed_down(spark):
    text = plan(queries.run("incremental_scan", spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in text
