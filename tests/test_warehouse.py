"""The whole pipeline, twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kontor.operators import integrity
from kontor.plans import dimensions, reports
from kontor.plans import warehouse as jobs
from kontor.sources.tables import read_table


@pytest.fixture(scope="module")
def loaded(spark, src, tmp_path_factory):
    warehouse = jobs.Warehouse(spark, str(tmp_path_factory.mktemp("dw")))
    counts = jobs.load_dimensions(
        src, warehouse, calendar=dimensions.dates(spark, "1995-01-01", "2001-12-31"))
    counts["factinternetsalesreason"] = jobs.load_internet_sales_reasons(src, warehouse)
    counts["factinternetsales"] = jobs.load_internet_sales(src, warehouse)
    counts["factresellersales"] = jobs.load_reseller_sales(src, warehouse)
    counts["factsurveyresponse"] = jobs.load_survey_responses(src, warehouse)
    counts["factsalesquota"] = jobs.load_sales_quotas(src, warehouse)
    counts.update({k: v for k, v in jobs.load_finance(src, warehouse).items() if k != "dimcurrency"})
    return warehouse, counts


def test_everything_is_loaded(loaded):
    warehouse, counts = loaded
    assert set(counts) == set(jobs.LOAD_KEYS)
    assert all(counts.values())
    assert {name: warehouse[name].count() for name in counts} == counts
    assert set(warehouse) == set(counts) and len(warehouse) == len(counts)


def test_keys_are_consecutive(loaded):
    warehouse, counts = loaded
    for name, key in jobs.SURROGATE_KEYS.items():
        low, high, n = warehouse[name].agg(F.min(key), F.max(key), F.count_distinct(key)).first()
        assert (low, high, n) == (1, counts[name], counts[name]), name


def test_second_load_adds_nothing(loaded, src, spark):
    warehouse, counts = loaded
    again = jobs.load_dimensions(
        src, warehouse, calendar=dimensions.dates(spark, "1995-01-01", "2001-12-31"))
    again["reasons"] = jobs.load_internet_sales_reasons(src, warehouse, gated=False)
    again["internet"] = jobs.load_internet_sales(src, warehouse, gated=False)
    again["resellers"] = jobs.load_reseller_sales(src, warehouse, gated=False)
    again["survey"] = jobs.load_survey_responses(src, warehouse, gated=False)
    again["quotas"] = jobs.load_sales_quotas(src, warehouse, gated=False)
    again.update(jobs.load_finance(src, warehouse))
    assert not any(again.values()), again


def test_gates_shut_after_a_load(loaded, src):
    warehouse, _ = loaded
    assert jobs.load_internet_sales(src, warehouse) == 0
    assert jobs.load_internet_sales_reasons(src, warehouse) == 0
    assert jobs.load_survey_responses(src, warehouse) == 0


def test_lines_are_numbered_in_every_order(loaded):
    warehouse, _ = loaded
    fact = warehouse["factinternetsales"]
    assert integrity.pk_violations(fact, ["salesordernumber", "salesorderlinenumber"]).isEmpty()
    gaps = fact.groupBy("salesordernumber").agg(
        F.max("salesorderlinenumber").alias("last"), F.count(F.lit(1)).alias("n")
    ).filter("last <> n")
    assert gaps.isEmpty()


def test_facts_point_at_dimensions(loaded):
    warehouse, _ = loaded
    fact = warehouse["factresellersales"]
    for key, table in (("productkey", "dimproduct"), ("resellerkey", "dimreseller"), ("employeekey", "dimemployee"),
                       ("promotionkey", "dimpromotion"), ("currencykey", "dimcurrency"), ("salesterritorykey", "dimsalesterritory")):
        assert integrity.fk_orphans(fact, key, warehouse[table], key).isEmpty(), key
    assert integrity.fk_orphans(fact, "orderdatekey", warehouse["dimdate"], "datekey").isEmpty()


def test_reports_add_up(loaded):
    warehouse, _ = loaded
    fact, days = warehouse["factinternetsales"], warehouse["dimdate"]
    total = fact.agg(F.sum("salesamount")).first()[0]
    quarters = reports.sales_by_quarter_region(fact, days, warehouse["dimsalesterritory"])
    assert quarters.agg(F.sum(reports.SALES)).first()[0] == total
    wide = reports.region_pivot(quarters)
    regions = [name for name in wide.columns if name not in (reports.YEAR, reports.QUARTER)]
    assert sorted(regions) == sorted(row[0] for row in reports.regions(quarters).collect())
    # The mean has more digits than the sum, but of one value is that value.
    assert sum(sum(row[name] or 0 for name in regions) for row in wide.collect()) == total
    months = reports.sales_by_month(fact, days)
    assert reports.sales_by_month_all_years(months).agg(F.sum(reports.SALES)).first()[0] == total
    one = reports.region_trend(quarters, regions[0]).collect()
    assert {row[reports.REGION] for row in one} == {regions[0]}
    resold = warehouse["factresellersales"]
    shares = reports.channel_share(reports.sales_by_channel(fact, resold)).collect()
    assert abs(sum(row[reports.SHARE] for row in shares) - 100) < 0.11
    stores = reports.store_sales_by_month(resold, days, warehouse["dimreseller"])
    assert stores.agg(F.sum(reports.SALES)).first()[0] == resold.agg(F.sum("salesamount")).first()[0]
    top = reports.top_stores(stores).collect()
    best = reports.top_store_quarters(stores)
    assert {row[reports.STORE] for row in best.collect()} == {row[reports.STORE] for row in top}
    assert not any(None in tuple(row) for row in reports.store_pivot(best).collect())


def test_new_rows_continue_the_keys(loaded, src, frame):
    warehouse, counts = loaded
    before = {row.currencyalternatekey: row.currencykey for row in warehouse["dimcurrency"].collect()}
    more = frame([("AAA", "new"), ("USD", "known")], "currencyalternatekey STRING, currencyname STRING")
    assert warehouse.load("dimcurrency", more) == 1
    after = {row.currencyalternatekey: row.currencykey for row in warehouse["dimcurrency"].collect()}
    assert after == {**before, "AAA": counts["dimcurrency"] + 1}


def test_datamart(loaded, tmp_path, spark):
    warehouse, counts = loaded
    refreshed = jobs.refresh_datamart(warehouse, str(tmp_path))
    assert refreshed["dm_factresellersales"] == counts["factresellersales"]
    assert refreshed["dm_dimproduct"] == counts["dimproduct"]
    assert jobs.refresh_datamart(warehouse, str(tmp_path)) == refreshed
    fact = read_table(spark, str(tmp_path / "dm_factresellersales"))
    assert fact.filter(F.col("Profit") != F.col("salesamount") - F.col("totalproductcost")).isEmpty()


def test_incremental_load(spark, src, tmp_path):
    """Loading the older orders and then those changed since gives all orders."""
    warehouse = jobs.Warehouse(spark, str(tmp_path))
    moment = dt.datetime(1998, 1, 1)
    orders = src["salesorderheader"]
    warehouse.load("orders", orders.filter(F.col("orderdate") < F.lit(str(moment)).cast("timestamp_ntz")), ["salesorderid"])
    from kontor.operators.columns import since
    warehouse.load("orders", since(orders, dt.datetime(1997, 6, 1)), ["salesorderid"])
    assert warehouse["orders"].count() == orders.count()
