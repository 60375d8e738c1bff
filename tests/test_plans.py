"""Builders on tiny source tables."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import values
from pyspark.sql import functions as F

from kontor import schemas
from kontor.plans import datamart, dimensions, facts, finance
from pyspark.sql import types as T

D = Decimal


def test_calendar(spark):
    days = {row.datekey: row for row in dimensions.dates(spark).collect()}
    assert len(days) == 7670
    first = days[20050101]
    assert (first.daynumberofweek, first.weeknumberofyear, first.englishdaynameofweek) == (6, 53, "Saturday")
    assert days[20121231].weeknumberofyear == 1 and 20080229 in days
    assert (days[20200630].calendarsemester, days[20200701].calendarsemester) == (1, 2)
    assert days[20200701].fiscalquarter == 3 and days[20200701].spanishmonthname == "Julio"
    assert first.fulldatealternatekey == dt.datetime(2005, 1, 1)


def test_calendar_of_one_day(spark):
    assert dimensions.dates(spark, "2020-02-29", "2020-02-29").count() == 1


def test_calendar_reaches_orders_outside(frame):
    orders = frame([(dt.datetime(2004, 12, 30),), (dt.datetime(2020, 1, 1),), (None,)], "orderdate TIMESTAMP_NTZ")
    assert dimensions.dates_including(orders, "orderdate").count() == 7670 + 2
    assert dimensions.dates_including(orders.limit(0), "orderdate").count() == 7670


def product_source(frame):
    return {
        "productsubcategory": frame([(1,)], "productsubcategoryid INT"),
        "product": frame(
            [(1, "P1", "A", D("9.5"), None, None, 1, dt.date(2020, 1, 1)),
             (2, "P2", "B", D("1"), "red", dt.date(2021, 1, 1), 9, dt.date(2021, 1, 1))],
            "productid INT, productnumber STRING, name STRING, listprice DECIMAL(18,4), color STRING, "
            "sellenddate DATE, productsubcategoryid INT, modifieddate DATE"),
    }


def test_products(frame):
    found = dimensions.products(product_source(frame))
    assert values(found, "productalternatekey", "status", "color", "productsubcategorykey", "sizerange") == [
        ("P1", "Current", "NA", 1, "NA"), ("P2", "Discontinued", "red", None, "NA")]
    assert found.columns == T.StructType.fromDDL(schemas.DIM_PRODUCT).names
    assert dimensions.products(product_source(frame), since=dt.date(2021, 1, 1)).count() == 1


def test_product_without_end_as_text(frame):
    source = product_source(frame)
    source["product"] = source["product"].withColumn("sellenddate", F.lit(None).cast("string"))
    assert {row.status for row in dimensions.products(source).collect()} == {"Current"}


def sales_source(frame, lines):
    """Orders 1 and 2 of customer 1, who buys for store 5 with two accounts."""
    at = dt.datetime(2020, 3, 1)
    return {
        "salesorderheader": frame(
            [(1, "SO1", 8, at, at, at, D("1"), D("2"), "PO", 1, 50, 3, None, at),
             (2, "SO2", 9, at, at, None, D("1"), D("2"), None, 1, 50, 3, 7, at),
             (3, "SO3", None, at, at, at, D("1"), D("2"), None, 2, 51, 3, 7, at)],
            "salesorderid INT, salesordernumber STRING, revisionnumber INT, orderdate TIMESTAMP_NTZ, "
            "duedate TIMESTAMP_NTZ, shipdate TIMESTAMP_NTZ, taxamt DECIMAL(18,4), freight DECIMAL(18,4), "
            "purchaseordernumber STRING, customerid INT, salespersonid INT, territoryid INT, currencyrateid INT, "
            "modifieddate TIMESTAMP_NTZ"),
        "salesorderdetail": frame(
            lines, "salesorderid INT, productid INT, specialofferid INT, orderqty INT, unitprice DECIMAL(15,2), "
            "unitpricediscount DECIMAL(4,2), linetotal DECIMAL(18,4), carriertrackingnumber STRING"),
        "product": frame([(1, "P1", D("3")), (2, "P2", D("4"))], "productid INT, productnumber STRING, standardcost DECIMAL(18,4)"),
        "customer": frame(
            [(1, 10, 5, "AW1"), (2, 11, None, "AW2"), (8, None, 5, "RS8"), (9, None, 5, "RS9")],
            "customerid INT, personid INT, storeid INT, accountnumber STRING"),
        "currencyrate": frame([(7, "EUR")], "currencyrateid INT, tocurrencycode STRING"),
        "employee": frame([(50, "N50")], "businessentityid INT, nationalidnumber STRING"),
        "salesreason": frame([(1,), (2,)], "salesreasonid INT"),
        "salesorderheadersalesreason": frame([(1, 1), (1, 2), (2, 1)], "salesorderid INT, salesreasonid INT"),
    }


LINES = [
    (1, 2, 0, 1, D("10"), D("0"), D("10"), None), (1, 1, 0, 2, D("5"), D("0.10"), D("9"), "T"),
    (1, 9, 0, 1, D("1"), D("0"), D("1"), None), (2, 1, 0, 1, D("5"), D("0"), D("5"), None),
    (3, 1, 0, 1, D("5"), D("0"), D("5"), None),
]


@pytest.fixture
def dims(frame):
    return {
        "dimproduct": frame([("P1", 101), ("P2", 102)], "productalternatekey STRING, productkey INT"),
        "dimcustomer": frame([("AW1", 201)], "customeralternatekey STRING, customerkey INT"),
        "dimpromotion": frame([(0, 1)], "promotionalternatekey INT, promotionkey INT"),
        "dimcurrency": frame([("USD", 1), ("EUR", 2)], "currencyalternatekey STRING, currencykey INT"),
        "dimsalesterritory": frame([(3, 30)], "salesterritoryalternatekey INT, salesterritorykey INT"),
        "dimreseller": frame([("RS8", 8)], "reselleralternatekey STRING, resellerkey INT"),
        "dimemployee": frame([("N50", 500)], "employeenationalidalternatekey STRING, employeekey INT"),
        "dimsalesreason": frame([(1, 11)], "salesreasonalternatekey INT, salesreasonkey INT"),
    }


def test_internet_sales(frame, dims):
    found = facts.internet_sales(
        sales_source(frame, LINES), dims, load_date=dt.date(2026, 1, 1))
    # Order 2 is not shipped, order 3 has an unknown customer; the line with an
    # unknown product is numbered first and dropped then.
    assert values(found, "salesordernumber", "salesorderlinenumber", "productkey", "currencykey") == [
        ("SO1", 1, 101, 1), ("SO1", 2, 102, 1)]
    row = found.filter("productkey = 101").first()
    assert (row.discountamount, row.totalproductcost, row.orderdatekey) == (D("1"), D("6"), 20200301)
    assert (row.revisionnumber, row.saved) == (1, dt.date(2026, 1, 1))
    assert found.columns == T.StructType.fromDDL(schemas.FACT_INTERNET_SALES).names


def test_money_is_exact(frame, dims):
    source = sales_source(frame, LINES)
    source["salesorderdetail"] = frame(
        [(1, 1, 0, 3, D("1234567890123.4567"), D("0.1234"), D("3703703670370.3701"), None)],
        "salesorderid INT, productid INT, specialofferid INT, orderqty INT, unitprice DECIMAL(19,4), "
        "unitpricediscount DECIMAL(10,4), linetotal DECIMAL(19,4), carriertrackingnumber STRING")
    row = facts.internet_sales(source, dims).first()
    assert row.discountamount == D("1234567890123.4567") * 3 * D("0.1234")
    assert (row.unitprice, row.salesamount) == (D("1234567890123.4567"), D("3703703670370.3701"))


def test_lines_are_numbered_per_order_number(frame, dims):
    """Two orders under one number share its numbers; without a number there is none."""
    source = sales_source(frame, LINES)
    source["salesorderheader"] = source["salesorderheader"].withColumn(
        "salesordernumber", F.when(F.col("salesorderid") < 3, F.lit("SO1")))
    rows = facts.reseller_sales(source, dims).collect()
    assert {row.salesordernumber for row in rows} == {"SO1"}
    assert len({row.salesorderlinenumber for row in rows}) == len(rows) == 3
    source["salesorderheader"] = source["salesorderheader"].withColumn(
        "salesordernumber", F.lit(None).cast("string"))
    assert {row.salesorderlinenumber for row in facts.reseller_sales(source, dims).collect()} == {None}


@pytest.mark.parametrize("large", [0, 2, 4])
@pytest.mark.parametrize("build", [facts.internet_sales, facts.reseller_sales])
def test_many_lines_have_the_same_numbers(frame, dims, monkeypatch, large, build):
    """Orders that share a number, repeat, have none, or one of their own."""
    source = sales_source(frame, [*LINES, *LINES[:2], (4, 1, 0, 1, D("5"), D("0"), D("5"), None),
                                  (None, 1, 0, 1, D("5"), D("0"), D("5"), None)])
    headers = source["salesorderheader"].withColumn("shipdate", F.col("orderdate"))
    more = headers.filter("salesorderid = 1")
    source["salesorderheader"] = headers.unionByName(more).unionByName(
        more.withColumns({"salesorderid": F.lit(4), "salesordernumber": F.lit("SO2")})
    ).unionByName(more.withColumns({"salesorderid": F.lit(2), "salesordernumber": F.lit(None).cast("string")})
    ).unionByName(more.withColumns({"salesorderid": F.lit(None).cast("int"), "salesordernumber": F.lit("SO1")}))
    wanted = values(build(source, dims).drop("saved"))
    monkeypatch.setattr(facts, "LARGE", large)
    assert wanted and values(build(source, dims).drop("saved")) == wanted


def test_internet_sales_channel_and_since(frame, dims):
    source = sales_source(frame, LINES)
    assert facts.internet_sales(source, dims, channel=F.col("salesordernumber") == "SO2").count() == 0
    assert facts.internet_sales(source, dims, since=dt.datetime(2020, 3, 2)).count() == 0
    assert facts.internet_sales(source, dims, since=dt.datetime(2020, 3, 1)).count() == 2


def test_missing_dimension_gives_no_rows(frame, dims):
    del dims["dimpromotion"]
    assert facts.internet_sales(sales_source(frame, LINES), dims).count() == 0


def test_reseller_sales(frame, dims):
    found = facts.reseller_sales(sales_source(frame, LINES), dims)
    # Each line appears per account of the store; those of the account that is
    # not in the dimension are numbered and dropped.
    assert values(found, "salesordernumber", "salesorderlinenumber", "productkey", "resellerkey", "revisionnumber", "currencykey") == [
        ("SO1", 1, 101, 8, 1, 1), ("SO1", 3, 102, 8, 1, 1), ("SO2", 1, 101, 8, 2, 2)]
    assert {row.employeekey for row in found.collect()} == {500}


@pytest.mark.parametrize("copy_limit", [1, 1000])
def test_sales_reasons(frame, dims, copy_limit):
    found = facts.internet_sales_reasons(sales_source(frame, LINES), dims, copy_limit=copy_limit)
    assert values(found, "salesordernumber", "salesreasonkey", "salesorderlinenumber") == [
        ("SO1", None, None), ("SO1", None, None), ("SO1", None, None),
        ("SO1", 11, 1), ("SO1", 11, 2), ("SO1", 11, 3), ("SO2", 11, 1)]


def test_sales_quotas(frame, dims):
    source = {
        "employee": frame([(50, "N50"), (51, "N51")], "businessentityid INT, nationalidnumber STRING"),
        "salespersonquotahistory": frame(
            [(50, "2020-05-06 07:08:09", D("5")), (50, "never", D("6")), (51, "2020-05-06", D("7")), (52, "2020-05-06", D("8"))],
            "businessentityid INT, quotadate STRING, salesquota DECIMAL(18,4)"),
    }
    assert values(facts.sales_quotas(source, dims)) == [
        (500, 20200506, 2020, 2, D("5"), dt.datetime(2020, 5, 6, 7, 8, 9))]


def test_survey_responses(frame, dims):
    source = sales_source(frame, LINES)
    source.update({
        "product": frame([(1, 1), (2, 2)], "productid INT, productsubcategoryid INT"),
        "productsubcategory": frame([(1, 1), (2, 1)], "productsubcategoryid INT, productcategoryid INT"),
        "productcategory": frame([(1,)], "productcategoryid INT"),
        "person": frame([(10, "x"), (11, None)], "businessentityid INT, demographics STRING"),
    })
    dims.update({
        "dimproductcategory": frame([(1, 91, "Bikes")], "productcategoryalternatekey INT, productcategorykey INT, englishproductcategoryname STRING"),
        "dimproductsubcategory": frame([(1, 81, "Road")], "productsubcategoryalternatekey INT, productsubcategorykey INT, englishproductsubcategoryname STRING"),
    })
    # Both orders of that day are one answer; subcategory 2 is not loaded.
    assert values(facts.survey_responses(source, dims)) == [
        (20200301, 201, 91, "Bikes", 81, "Road", dt.datetime(2020, 3, 1))]


def test_resellers(frame):
    at = dt.date(2020, 1, 1)
    survey = "<S><BusinessType> OS </BusinessType><AnnualSales>$1,5</AnnualSales></S>"
    source = {
        "customer": frame(
            [(8, None, 5, "RS8", at), (9, 1, 5, "AW9", at), (10, None, None, "RS10", at)],
            "customerid INT, personid INT, storeid INT, accountnumber STRING, modifieddate DATE"),
        "store": frame([(5, "Shop", survey)], "businessentityid INT, name STRING, demographics STRING"),
        "businessentityaddress": frame([(5, 2), (5, 1)], "businessentityid INT, addressid INT"),
        "address": frame([(1, "A St", None, "Rome ", "7"), (2, "B St", None, "Rome", "8")],
                         "addressid INT, addressline1 STRING, addressline2 STRING, city STRING, postalcode STRING"),
        "businessentitycontact": frame([(5, 70)], "businessentityid INT, personid INT"),
        "personphone": frame([(70, "555")], "businessentityid INT, phonenumber STRING"),
        "salesorderheader": frame(
            [(9, dt.datetime(2001, 2, 3)), (9, dt.datetime(2003, 4, 5))], "customerid INT, orderdate TIMESTAMP_NTZ"),
    }
    geography = frame([(3, "rome", "7 "), (4, "ROME", "8")], "geographykey INT, city STRING, postalcode STRING")
    found = {row.reselleralternatekey: row for row in dimensions.resellers(source, geography).collect()}
    shop = found["RS8"]
    assert (shop.addressline1, shop.geographykey, shop.phone) == ("A St", 3, "555")
    assert (shop.businesstype, shop.orderfrequency, shop.annualsales) == ("Warehouse", "Q", 15.0)
    assert (shop.firstorderyear, shop.lastorderyear, shop.ordermonth) == (2001, 2003, 4)
    bare = found["RS10"]
    assert (bare.resellername, bare.businesstype, bare.geographykey) == (None, None, None)
    assert len(found) == 2


def test_employees(src):
    found = dimensions.employees(src, None)
    assert found.columns == T.StructType.fromDDL(schemas.DIM_EMPLOYEE).names
    rows = found.collect()
    assert all((row.status == "Current") == (row.enddate is not None) for row in rows)
    assert all(row.currentflag == (row.salariedflag is not None) for row in rows)
    assert all(row.salesterritorykey is None and row.namestyle is not None for row in rows)


def test_unreadable_income_stays(frame):
    from kontor.functions.survey import INDIVIDUAL_NAMESPACE
    whole = (f'<S xmlns="{INDIVIDUAL_NAMESPACE}"><BirthDate>1</BirthDate><MaritalStatus>S</MaritalStatus>'
             "<YearlyIncome>much</YearlyIncome><TotalChildren>0</TotalChildren>{}</S>")
    source = {
        "customer": frame([(1, 10, 3, "AW1"), (2, 11, 3, "AW2"), (3, None, 3, "RS")],
                          "customerid INT, personid INT, territoryid INT, accountnumber STRING"),
        "person": frame(
            [(10, whole.format("<NumberChildrenAtHome>0</NumberChildrenAtHome>")), (11, whole.format(""))],
            "businessentityid INT, demographics STRING").selectExpr(
                "*", "'x' persontype", "0 emailpromotion", "'x' additionalcontactinfo"),
        "emailaddress": frame([], "businessentityid INT, emailaddress STRING"),
        "address": frame([(1, "A St", None)], "addressid INT, addressline1 STRING, addressline2 STRING"),
    }
    assert values(dimensions.customers(source), "customeralternatekey", "geographykey", "yearlyincome", "addressline1") == [
        ("AW1", 3, None, "A St")]


def test_finance(spark, src):
    assert finance.scenarios(spark).count() == 3
    accounts = {row.accountkey: row for row in finance.accounts(spark).collect()}
    assert len(accounts) == 12
    assert all(row.parentaccountkey is None or row.parentaccountkey in accounts for row in accounts.values())
    tree = finance.department_groups(src).collect()
    assert [row.departmentgroupname for row in tree if row.parentdepartmentgroupkey is None] == ["Corporate"]
    organizations = {row.organizationkey: row for row in finance.organizations(src, seed=1).collect()}
    for row in organizations.values():
        if row.parentorganizationkey is None:
            assert row.organizationname.endswith(" Division") and 0 <= row.percentageofownership < 1
        else:
            assert organizations[row.parentorganizationkey].organizationname == f"{row.organizationname} Division"
            assert row.organizationkey > len(organizations) / 2 and row.percentageofownership is None
    again = finance.organizations(src, seed=1).collect()
    assert {row.organizationkey: row for row in again} == organizations


def test_mart_measures(frame):
    derived = datamart.mart_reseller_sales(
        frame([(10.0, 1.0, 2, 3.0)], "extendedamount DOUBLE, discountamount DOUBLE, orderquantity INT, productstandardcost DOUBLE"))
    row = derived.first()
    assert (row.SalesAmount, row.TotalProductCost, row.Profit) == (9.0, 6.0, 3.0)
    kept = datamart.mart_reseller_sales(
        frame([(5.0, float("nan"), 10.0, 1.0)], "salesamount DOUBLE, totalproductcost DOUBLE, extendedamount DOUBLE, discountamount DOUBLE"))
    assert kept.columns[-1] == "Profit" and tuple(kept.first()) == (5.0, None, 10.0, 1.0, None)
    nothing = frame([(1,)], "other INT")
    assert datamart.mart_reseller_sales(nothing).columns == ["other"]


def test_mart_dimension(frame):
    rows = frame([(2, "b", 1.0), (2, "a", float("nan")), (None, "x", 1.0), (None, "y", 1.0)], "PRODUCTKEY INT, n STRING, v DOUBLE")
    assert values(datamart.mart_dimension(rows, ["ProductKey"])) == [(None, "x", 1.0), (2, "a", None)]
