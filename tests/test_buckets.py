"""Orders in buckets: the same facts, without an exchange of lines before they are numbered."""

import uuid
from collections import ChainMap

import pytest
from helpers import values
from pyspark.sql import functions as F

from kontor.operators.lookup import broadcast_if_few
from kontor.plans import facts
from kontor.sources.buckets import (
    APART, HEADERS, IN_BUCKETS, KEY, LINES, bucketed_source, lines_to_join, write_bucketed, write_orders,
)


@pytest.fixture
def bucketed(spark, tmp_path):
    """Writes orders to buckets and returns the source that reads them."""
    def write(src, limit, buckets=4):
        prefix = f"t{uuid.uuid4().hex}_"
        write_orders(src, str(tmp_path / prefix), buckets, prefix, limit)
        return bucketed_source(spark, src, prefix)
    return write


@pytest.fixture
def odd(src):
    """The source with headers and lines without order id."""
    unknown = F.lit(None).cast(src[LINES].schema[KEY].dataType)
    return ChainMap({
        HEADERS: src[HEADERS].unionByName(src[HEADERS].limit(5).withColumn(KEY, unknown)),
        LINES: src[LINES].unionByName(src[LINES].limit(5).withColumn(KEY, unknown)),
    }, src)


@pytest.mark.parametrize("limit", [0, 6, 1 << 20])
def test_same_facts(odd, star, bucketed, limit):
    laid_out = bucketed(odd, limit)
    for name in (HEADERS, LINES):
        assert laid_out[name].exceptAll(odd[name]).isEmpty()
        assert odd[name].exceptAll(laid_out[name]).isEmpty()
    large = odd[LINES].filter(f"{KEY} IS NOT NULL").groupBy(KEY).count().filter(F.col("count") > limit)
    assert laid_out[LINES + APART].filter(f"{KEY} IS NOT NULL").select(KEY).distinct().count() == large.count()
    assert laid_out[LINES + IN_BUCKETS].filter(f"{KEY} IS NULL").isEmpty()
    for build in (facts.internet_sales, facts.reseller_sales):
        plain = build(odd, star).drop("saved")
        assert values(build(laid_out, star).drop("saved")) == values(plain)
        assert plain.count() > 0


def exchanges_above(node, table, seen=0):
    """Shuffles on the way from each scan of a table to the first window above it."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from exchanges_above(node.initialPlan(), table, seen)
        return
    if name == "WindowExec":
        seen = 0
    elif name == "ShuffleExchangeExec":
        seen += 1
    elif name == "FileSourceScanExec" and table in node.simpleString(1000):
        yield seen
    for i in range(node.children().size()):
        yield from exchanges_above(node.children().apply(i), table, seen)


@pytest.mark.parametrize("build", [facts.internet_sales, facts.reseller_sales])
def test_lines_are_exchanged_for_their_numbers_only(spark, src, star, bucketed, build):
    laid_out = bucketed(src, 1 << 20)
    assert len(lines_to_join(laid_out)) == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        plan = build(laid_out, star)._jdf.queryExecution().executedPlan()
        assert list(exchanges_above(plan, f"{LINES}{IN_BUCKETS}")) == [1]
        plan = build(src, star)._jdf.queryExecution().executedPlan()
        assert list(exchanges_above(plan, "lineitem")) == [2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_bucket_is_one_file(spark, src, tmp_path):
    table = f"t{uuid.uuid4().hex}"
    write_bucketed(src[LINES], table, str(tmp_path), KEY, 4)
    assert len(spark.table(table + IN_BUCKETS).inputFiles()) == 4
    with pytest.raises(Exception, match="(?i)exists"):
        write_bucketed(src[LINES], table, str(tmp_path), KEY, 4)


def test_nothing(src, star, bucketed):
    none = ChainMap({name: src[name].limit(0) for name in (HEADERS, LINES)}, src)
    laid_out = bucketed(none, 3)
    assert facts.internet_sales(laid_out, star).isEmpty()
    assert facts.reseller_sales(laid_out, star).isEmpty()


def test_broadcast_only_if_few(spark):
    few = broadcast_if_few(spark.range(3), 3)
    many = broadcast_if_few(spark.range(4), 3)
    assert "broadcast" in few._jdf.queryExecution().logical().toString()
    assert "broadcast" not in many._jdf.queryExecution().logical().toString()


@pytest.mark.parametrize("build", [facts.internet_sales, facts.reseller_sales])
def test_many_lines_are_numbered_where_they_met_their_headers(spark, src, star, bucketed, build, monkeypatch):
    laid_out = bucketed(src, 1 << 20)
    plain = build(src, star).drop("saved")
    monkeypatch.setattr(facts, "LARGE", 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        found = build(laid_out, star)
        assert list(exchanges_above(found._jdf.queryExecution().executedPlan(), f"{LINES}{IN_BUCKETS}")) == [0]
        assert values(found.drop("saved")) == values(plain)
        found = build(src, star)
        assert list(exchanges_above(found._jdf.queryExecution().executedPlan(), "lineitem")) == [1]
        assert values(found.drop("saved")) == values(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
