"""The facts of the sales warehouse.

Each function takes the source tables by name and the loaded dimensions by name
(with surrogate keys), and returns rows ready to load.

How the sales facts are laid out for scale: lookups that depend on the order
are made on the order headers, and a product meets its surrogate key in the
product table, so order lines are joined twice only (product, header); products that are counted to
be few are broadcast, and lines in buckets meet their headers where they lie.  A load of changed
orders cuts the lines to these orders before anything else.  Lines are numbered
per order number where they meet; an order of over a million lines is numbered over ranges.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor import schemas
from kontor.functions import calendar
from kontor.operators.columns import conform
from kontor.operators.columns import since as changed
from kontor.operators.loading import stamp
from kontor.operators.lookup import broadcast_if_few, lookup_key
from kontor.operators.numbering import COPY_LIMIT, LARGE, expand_copies, line_number
from kontor.session import stored
from kontor.sources.buckets import headers_to_join, lines_to_join

Tables = Mapping[str, DataFrame]

# Fixed values.
DEFAULT_CURRENCY = "USD"
FIRST_REVISION = 8

_NUMBER = "salesorderlinenumber"

# Lines of one order are numbered by these columns first, then by all others.
_LINE_ORDER = [
    "product_bk", "promotion_bk", "orderquantity", "unitprice", "unitpricediscountpct",
    "extendedamount", "carriertrackingnumber",
]


def _date_keys() -> dict[str, Column]:
    return {f"{name}key": calendar.date_key(F.col(name)) for name in ("orderdate", "duedate", "shipdate")}


def _currency_keys(headers: DataFrame, src: Tables, dims: Tables) -> DataFrame:
    """Order headers with their currency key; no rate means the default currency."""
    rates = src["currencyrate"].select(
        "currencyrateid", F.col("tocurrencycode").alias("currency_bk")
    )
    priced = headers.join(rates, "currencyrateid", "left").na.fill(
        {"currency_bk": DEFAULT_CURRENCY}
    )
    return lookup_key(
        priced, dims.get("dimcurrency"), "currency_bk", "currencyalternatekey", "currencykey"
    )


def _territory_keys(headers: DataFrame, dims: Tables) -> DataFrame:
    return lookup_key(
        headers, dims.get("dimsalesterritory"),
        "territoryid", "salesterritoryalternatekey", "salesterritorykey",
    )


def _discount(price: Column, share: Column, quantity: Column) -> Column:
    """Price times share times quantity with all eight decimals.

    Spark would give up decimals where the product of the types has more than 38 digits.
    """
    return (price * share).cast("decimal(27,8)") * quantity.cast("decimal(10,0)")


def _catalog(src: Tables, dims: Tables) -> DataFrame:
    """Products with their surrogate key."""
    return broadcast_if_few(lookup_key(
        src["product"].select("productid", F.col("productnumber").alias("product_bk"), "standardcost"),
        dims.get("dimproduct"), "product_bk", "productalternatekey", "productkey",
    ))


def _lines(catalog: DataFrame, dims: Tables, detail: DataFrame, product_join: str) -> DataFrame:
    """Order lines with product and promotion keys, and what their amounts are made of."""
    promoted = lookup_key(
        detail, dims.get("dimpromotion"),
        "specialofferid", "promotionalternatekey", "promotionkey",
    )
    return promoted.join(catalog, "productid", product_join).select(
        "salesorderid", "product_bk", "productkey",
        F.col("specialofferid").alias("promotion_bk"), "promotionkey",
        F.col("orderqty").alias("orderquantity"), "unitprice",
        F.col("linetotal").alias("extendedamount"),
        F.col("unitpricediscount").alias("unitpricediscountpct"),
        F.col("standardcost").alias("productstandardcost"),
        "carriertrackingnumber",
    )


def _measured(lines: DataFrame) -> DataFrame:
    """Lines with the amounts that follow from the others; none of these is shuffled."""
    quantity = F.col("orderquantity")
    return lines.withColumns({
        "discountamount": _discount(F.col("unitprice"), F.col("unitpricediscountpct"), quantity),
        "totalproductcost": F.col("productstandardcost") * quantity,
        "salesamount": F.col("extendedamount"),
    })


def _of_orders(detail: DataFrame, headers: DataFrame, cut: bool) -> DataFrame:
    """The lines of the given orders; all lines if the orders weren't cut."""
    if not cut:
        return detail
    return detail.join(headers.select("salesorderid").distinct(), "salesorderid", "left_semi")


def _shared_numbers(orders: DataFrame) -> DataFrame:
    """Order numbers that stand for several order ids."""
    return stored(
        orders.filter(F.col("salesordernumber").isNotNull()).groupBy("salesordernumber")
        .agg(F.min("salesorderid").alias("_least"), F.max("salesorderid").alias("_largest"))
        .filter(F.col("_least") < F.col("_largest")).select("salesordernumber")
    )


def _numbered(
    src: Tables, dims: Tables, headers: DataFrame, orders: DataFrame, cut: bool, product_join: str
) -> DataFrame:
    """Order lines joined to their headers and numbered within the order number.

    Which orders are large is told from the ids of lines and orders alone.  Of more than ``LARGE``
    lines, those whose order number stands for one order id are numbered where they have met
    their header, without a further exchange; the others by themselves.
    """
    details = lines_to_join(src)
    catalog = _catalog(src, dims)

    def numbered(headers: DataFrame, orders: DataFrame, details: list[DataFrame], within=()) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [
            headers.join(_lines(catalog, dims, detail, product_join), "salesorderid")
            for detail in details
        ])
        order = _LINE_ORDER + [
            name for name in rows.columns if name not in (*_LINE_ORDER, "salesordernumber")
        ]
        sizes = reduce(DataFrame.unionByName, [
            orders.select("salesorderid", "salesordernumber").join(
                detail.groupBy("salesorderid").agg(F.count(F.lit(1)).alias("rows")), "salesorderid")
            for detail in details
        ])
        bound = reduce(DataFrame.unionByName, details)
        return line_number(
            rows, ["salesordernumber"], order, _NUMBER, sizes, bound, LARGE, within)

    many = sum(detail.count() for detail in details) > LARGE
    details = [_of_orders(detail, orders, cut) for detail in details]
    if not many:
        return _measured(numbered(headers, orders, details))
    shared, apart = _shared_numbers(orders), []
    if not shared.isEmpty():
        shared = broadcast_if_few(shared)
        together = orders.join(shared, "salesordernumber", "left_semi")
        apart = [numbered(
            headers.join(shared, "salesordernumber", "left_semi"), together,
            [_of_orders(detail, together, True) for detail in details],
        )]
        headers, orders = (
            df.join(shared, "salesordernumber", "left_anti") for df in (headers, orders))
    # Parts of the lines share no order id.
    parts = [numbered(headers, orders, [detail], ["salesorderid"]) for detail in details]
    return _measured(reduce(DataFrame.unionByName, [*parts, *apart]))


def internet_sales(
    src: Tables,
    dims: Tables,
    since=None,
    load_date: dt.date | None = None,
    channel: Column | None = None,
) -> DataFrame:
    """Internet sales, one row per order line with all keys and amounts known.

    All orders count unless ``channel``, a condition on the order header, says
    otherwise.
    """
    accounts = lookup_key(
        src["customer"].select("customerid", "accountnumber"),
        dims.get("dimcustomer"), "accountnumber", "customeralternatekey", "customerkey",
    ).select("customerid", "customerkey")
    orders = changed(headers_to_join(src), since)
    if channel is not None:
        orders = orders.filter(channel)
    headers = orders.select(
        "salesorderid", "salesordernumber", "orderdate", "duedate", "shipdate", "taxamt",
        "freight", F.col("purchaseordernumber").alias("customerponumber"),
        "customerid", "territoryid", "currencyrateid",
    ).join(accounts, "customerid", "left")
    headers = _territory_keys(_currency_keys(headers, src, dims), dims).drop(
        "customerid", "territoryid", "currencyrateid", "currency_bk"
    )
    # Without these the whole order is dropped; other orders keep their numbers.
    headers = headers.na.drop("any", subset=[
        "orderdate", "duedate", "shipdate", "customerkey", "currencykey", "salesterritorykey",
        "salesordernumber", "taxamt", "freight",
    ])
    cut = since is not None or channel is not None
    numbered = _numbered(src, dims, headers, orders, cut, "left")
    complete = numbered.na.drop("any", subset=[
        "productkey", "promotionkey", "orderquantity", "unitprice", "extendedamount",
        "unitpricediscountpct", "discountamount", "productstandardcost", "totalproductcost",
        "salesamount",
    ])
    return conform(
        stamp(complete.withColumns({**_date_keys(), "revisionnumber": F.lit(1)}), load_date),
        schemas.FACT_INTERNET_SALES,
    )


def reseller_sales(
    src: Tables,
    dims: Tables,
    since=None,
    load_date: dt.date | None = None,
) -> DataFrame:
    """Sales by an employee to a person who buys for a store with an account.

    A store with several reseller accounts gives one row per account.
    """
    accounts = lookup_key(
        src["customer"].filter(F.col("personid").isNull()).select("storeid", "accountnumber"),
        dims.get("dimreseller"), "accountnumber", "reselleralternatekey", "resellerkey",
    ).select("storeid", "resellerkey")
    buyers = (
        src["customer"].filter(F.col("personid").isNotNull()).select("customerid", "storeid")
        .join(accounts, "storeid", "left").select("customerid", "resellerkey")
    )
    sellers = lookup_key(
        src["employee"].select(F.col("businessentityid").alias("salespersonid"), "nationalidnumber"),
        dims.get("dimemployee"),
        "nationalidnumber", "employeenationalidalternatekey", "employeekey",
    ).select("salespersonid", "employeekey")
    orders = changed(headers_to_join(src), since)
    headers = (
        orders.select(
            "salesorderid", "salesordernumber", "orderdate", "duedate", "shipdate", "taxamt",
            "freight", F.col("purchaseordernumber").alias("customerponumber"),
            "customerid", "salespersonid", "territoryid", "currencyrateid",
            F.when(F.col("revisionnumber") == FIRST_REVISION, 1).otherwise(2).alias("revisionnumber"),
        )
        .join(buyers, "customerid")
        .join(sellers, "salespersonid")
    )
    headers = _territory_keys(_currency_keys(headers, src, dims), dims).drop(
        "customerid", "salespersonid", "territoryid", "currencyrateid", "currency_bk"
    )
    headers = headers.na.drop("any", subset=["orderdate", "employeekey", "currencykey"])
    numbered = _numbered(src, dims, headers, orders, since is not None, "inner")
    # One order may have known and unknown resellers: dropped after numbering.
    complete = numbered.na.drop("any", subset=["productkey", "resellerkey"])
    return conform(
        stamp(complete.withColumns(_date_keys()), load_date), schemas.FACT_RESELLER_SALES
    )


def internet_sales_reasons(
    src: Tables,
    dims: Tables,
    since=None,
    load_date: dt.date | None = None,
    copy_limit: int = COPY_LIMIT,
) -> DataFrame:
    """Reasons of each order, once per order line, the copies numbered.

    Lines are counted per order before any join and written out again at the
    end; no join ever sees the copies.
    """
    headers = changed(src["salesorderheader"], since).select("salesorderid", "salesordernumber")
    counts = _of_orders(src["salesorderdetail"], headers, since is not None).groupBy(
        "salesorderid"
    ).agg(F.count(F.lit(1)).alias("_lines"))
    bridge = src["salesorderheadersalesreason"].select("salesorderid", "salesreasonid")
    reasons = lookup_key(
        src["salesreason"].select("salesreasonid"), dims.get("dimsalesreason"),
        "salesreasonid", "salesreasonalternatekey", "salesreasonkey",
    )
    copies = (
        headers.join(counts, "salesorderid").join(bridge, "salesorderid")
        .join(reasons, "salesreasonid")
        .groupBy("salesordernumber", "salesreasonkey").agg(F.sum("_lines").alias("_copies"))
    )
    known = F.col("salesordernumber").isNotNull() & F.col("salesreasonkey").isNotNull()
    numbered = expand_copies(copies, "_copies", _NUMBER, copy_limit).withColumn(
        _NUMBER, F.when(known, F.col(_NUMBER))
    )
    return conform(stamp(numbered, load_date), schemas.FACT_SALES_REASON)


def survey_responses(src: Tables, dims: Tables, since=None) -> DataFrame:
    """What surveyed customers bought: one row per order date, customer,
    category and subcategory.
    """
    subcategories = src["productsubcategory"].select("productsubcategoryid", "productcategoryid")
    categories = src["productcategory"].select("productcategoryid")
    classified = subcategories.join(categories, "productcategoryid")
    products = src["product"].select("productid", "productsubcategoryid").join(
        classified, "productsubcategoryid"
    )
    orders = changed(src["salesorderheader"], since)
    bought = (
        _of_orders(src["salesorderdetail"], orders, since is not None)
        .select("salesorderid", "productid").join(products, "productid")
        .select("salesorderid", "productcategoryid", "productsubcategoryid")
    )
    surveyed = src["person"].filter(F.col("demographics").isNotNull()).select(
        F.col("businessentityid").alias("personid")
    )
    accounts = lookup_key(
        src["customer"].select("customerid", "personid", "accountnumber")
        .join(surveyed, "personid"),
        dims.get("dimcustomer"), "accountnumber", "customeralternatekey", "customerkey",
    ).select("customerid", "accountnumber", "customerkey")
    headers = orders.select("salesorderid", "orderdate", "customerid").join(accounts, "customerid")
    answers = headers.join(bought, "salesorderid").select(
        "orderdate", "accountnumber", "customerkey", "productcategoryid", "productsubcategoryid"
    ).distinct()
    for what in ("category", "subcategory"):
        answers = _named_lookup(answers, dims[f"dimproduct{what}"], what)
    complete = answers.withColumns({
        "datekey": calendar.date_key(F.col("orderdate")), "date": F.col("orderdate"),
    }).na.drop(
        "any", subset=["datekey", "customerkey", "productcategorykey", "productsubcategorykey"]
    )
    return conform(complete, schemas.FACT_SURVEY_RESPONSE)


def _named_lookup(rows: DataFrame, dimension: DataFrame, what: str) -> DataFrame:
    """Surrogate key and English name of a product category or subcategory."""
    found = dimension.select(
        F.col(f"product{what}alternatekey").alias("_alternate"),
        F.col(f"product{what}key").alias("_key"),
        F.col(f"englishproduct{what}name").alias("_name"),
    )
    return rows.join(
        found, rows[f"product{what}id"].eqNullSafe(found["_alternate"]), "left"
    ).select(
        *rows.columns,
        F.col("_key").alias(f"product{what}key"),
        F.col("_name").alias(f"englishproduct{what}name"),
    )


def sales_quotas(src: Tables, dims: Tables, since=None) -> DataFrame:
    """Quotas of known employees on readable dates."""
    sellers = lookup_key(
        src["employee"].select("businessentityid", "nationalidnumber"), dims.get("dimemployee"),
        "nationalidnumber", "employeenationalidalternatekey", "employeekey",
    ).select("businessentityid", "employeekey")
    date = calendar.timestamp_or_null(F.col("quotadate"))
    dated = (
        changed(src["salespersonquotahistory"], since)
        .join(sellers, "businessentityid", "left")
        .select("employeekey", F.col("salesquota").alias("salesamountquota"), date.alias("date"))
        .na.drop("any", subset=["employeekey", "date"])
    )
    return conform(dated.withColumns({
        "datekey": calendar.date_key(F.col("date")),
        "calendaryear": F.year("date"),
        "calendarquarter": F.quarter("date"),
    }), schemas.FACT_SALES_QUOTA)
