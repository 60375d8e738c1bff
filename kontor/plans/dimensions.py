"""The dimensions of the sales warehouse.

Each function takes the source tables by name and returns the dimension without
surrogate key; the key is assigned when new rows are loaded.  ``since`` limits
the result to rows changed at or after a moment.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor import schemas
from kontor.functions import calendar, text
from kontor.functions.survey import with_individual_survey, with_store_survey
from kontor.operators.columns import conform, copy_columns
from kontor.operators.columns import since as changed
from kontor.operators.dedupe import first_per_key
from kontor.operators.lookup import PLACE, lookup_composite, lookup_key, translate

Tables = Mapping[str, DataFrame]

# Fixed values.
CALENDAR_START = "2005-01-01"
CALENDAR_END = "2025-12-31"
NOT_AVAILABLE = "NA"


def dates(spark, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    return calendar_rows(
        spark.range(1).select(F.to_date(F.lit(start)).alias("first"), F.to_date(F.lit(end)).alias("last"))
    )


def dates_covering(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last moment in ``column``."""
    return calendar_rows(
        df.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    )


def dates_including(df: DataFrame, column: str, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, and on to all moments in ``column``."""
    first, last = F.to_date(F.min(column)), F.to_date(F.max(column))
    return calendar_rows(df.agg(
        F.least(F.to_date(F.lit(start)), first).alias("first"),
        F.greatest(F.to_date(F.lit(end)), last).alias("last"),
    ))


def calendar_rows(bounds: DataFrame) -> DataFrame:
    days = bounds.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")
    )
    day = F.col("day")
    quarter = F.quarter(day)
    attributes = days.select(
        calendar.date_key(day).alias("datekey"),
        day.alias("fulldatealternatekey"),
        calendar.weekday_number(day).alias("daynumberofweek"),
        *[calendar.day_name(day, lang).alias(f"{lang}daynameofweek") for lang in calendar.DAY_NAMES],
        F.dayofmonth(day).alias("daynumberofmonth"),
        F.dayofyear(day).alias("daynumberofyear"),
        F.weekofyear(day).alias("weeknumberofyear"),
        *[calendar.month_name(day, lang).alias(f"{lang}monthname") for lang in calendar.MONTH_NAMES],
        F.month(day).alias("monthnumberofyear"),
        quarter.alias("calendarquarter"),
        F.year(day).alias("calendaryear"),
        calendar.semester(quarter).alias("calendarsemester"),
    )
    # The fiscal year is the calendar year.
    fiscal = copy_columns(attributes, {
        "fiscalquarter": "calendarquarter",
        "fiscalyear": "calendaryear",
        "fiscalsemester": "calendarsemester",
    })
    return conform(fiscal, schemas.DIM_DATE)


def _in_languages(df: DataFrame, what: str, dictionary: DataFrame | None) -> DataFrame:
    """Spanish and French versions of the English column ``what``."""
    targets = {"es": f"spanish{what}", "fr": f"french{what}"}
    return translate(df, f"english{what}", targets, dictionary)


def product_categories(src: Tables, since=None, dictionary: DataFrame | None = None) -> DataFrame:
    named = changed(src["productcategory"], since).select(
        F.col("productcategoryid").alias("productcategoryalternatekey"),
        F.col("name").alias("englishproductcategoryname"),
    )
    return conform(
        _in_languages(named, "productcategoryname", dictionary), schemas.DIM_PRODUCT_CATEGORY
    )


def product_subcategories(
    src: Tables, since=None, dictionary: DataFrame | None = None
) -> DataFrame:
    named = changed(src["productsubcategory"], since).select(
        F.col("productsubcategoryid").alias("productsubcategoryalternatekey"),
        F.col("name").alias("englishproductsubcategoryname"),
        F.col("productcategoryid").alias("productcategorykey"),
    )
    return conform(
        _in_languages(named, "productsubcategoryname", dictionary),
        schemas.DIM_PRODUCT_SUBCATEGORY,
    )


def products(src: Tables, since=None, dictionary: DataFrame | None = None) -> DataFrame:
    """Products; a subcategory that does not exist becomes null."""
    known = src["productsubcategory"].select(
        F.col("productsubcategoryid").alias("productsubcategorykey")
    )
    product = changed(src["product"], since)
    joined = product.join(
        known, product["productsubcategoryid"] == known["productsubcategorykey"], "left"
    )
    open_ended = F.col("sellenddate").isNull() | (F.col("sellenddate").cast("string") == "")
    named = joined.withColumnsRenamed({
        "name": "englishproductname",
        "productnumber": "productalternatekey",
        "sellstartdate": "startdate",
    }).withColumns({
        "enddate": F.col("sellenddate"),
        "status": F.when(open_ended, "Current").otherwise("Discontinued"),
        "sizerange": F.lit(NOT_AVAILABLE),
        "modelname": F.lit(NOT_AVAILABLE),
    }).na.fill({"color": NOT_AVAILABLE})
    return conform(_in_languages(named, "productname", dictionary), schemas.DIM_PRODUCT)


def currencies(src: Tables, since=None) -> DataFrame:
    renamed = changed(src["currency"], since).withColumnsRenamed(
        {"currencycode": "currencyalternatekey", "name": "currencyname"}
    )
    return conform(renamed, schemas.DIM_CURRENCY)


def promotions(src: Tables, since=None, dictionary: DataFrame | None = None) -> DataFrame:
    """Promotions; without dictionary the translated columns are copies."""
    renamed = changed(src["specialoffer"], since).withColumnsRenamed({
        "specialofferid": "promotionalternatekey",
        "description": "englishpromotionname",
        "type": "englishpromotiontype",
        "category": "englishpromotioncategory",
    })
    for what in ("promotionname", "promotiontype", "promotioncategory"):
        renamed = _in_languages(renamed, what, dictionary)
    return conform(renamed, schemas.DIM_PROMOTION)


def sales_reasons(src: Tables, since=None) -> DataFrame:
    renamed = changed(src["salesreason"], since).withColumnsRenamed({
        "salesreasonid": "salesreasonalternatekey",
        "name": "salesreasonname",
        "reasontype": "salesreasonreasontype",
    })
    filled = renamed.na.fill(NOT_AVAILABLE, ["salesreasonname", "salesreasonreasontype"])
    return conform(filled, schemas.DIM_SALES_REASON)


def sales_territories(src: Tables, since=None) -> DataFrame:
    renamed = changed(src["salesterritory"], since).withColumnsRenamed({
        "territoryid": "salesterritoryalternatekey",
        "name": "salesterritoryregion",
        "countryregioncode": "salesterritorycountry",
        "territorygroup": "salesterritorygroup",
    })
    return conform(renamed, schemas.DIM_SALES_TERRITORY)


def geographies(src: Tables, since=None, dictionary: DataFrame | None = None) -> DataFrame:
    """One row per address whose state, country and territory exist."""
    states = src["stateprovince"].select(
        "stateprovinceid", "stateprovincecode", "countryregioncode",
        F.col("name").alias("stateprovincename"),
        F.col("territoryid").alias("salesterritorykey"),
    )
    countries = src["countryregion"].select(
        "countryregioncode", F.col("name").alias("englishcountryregionname")
    )
    territories = src["salesterritory"].select(F.col("territoryid").alias("salesterritorykey"))
    places = states.join(countries, "countryregioncode").join(territories, "salesterritorykey")
    located = (
        changed(src["address"], since)
        .select("city", "postalcode", "stateprovinceid")
        .join(places, "stateprovinceid")
        .withColumn("ipaddresslocator", F.lit(NOT_AVAILABLE))
    )
    return conform(
        _in_languages(located, "countryregionname", dictionary), schemas.DIM_GEOGRAPHY
    )


def employees(src: Tables, territories: DataFrame | None, since=None) -> DataFrame:
    """One row per employee, pay record and department record.

    ``territories`` is the territory dimension with its surrogate key.  The
    status is ``Current`` where an end date is set, and the current flag says
    whether the salaried flag is known: both as the source system defines them.
    """
    same = "businessentityid"
    # Mail and phone belong to the person: an employee without one has neither.
    person = (
        src["person"].select(same, "firstname", "middlename", "lastname", "namestyle")
        .join(src["emailaddress"].select(same, "emailaddress"), same, "left")
        .join(src["personphone"].select(same, F.col("phonenumber").alias("phone")), same, "left")
    )
    seller = lookup_key(
        src["salesperson"].select(same, "territoryid"),
        territories, "territoryid", "salesterritoryalternatekey", "salesterritorykey",
    ).select(same, "salesterritorykey", F.lit(True).alias("salespersonflag"))
    posts = src["employeedepartmenthistory"].join(
        src["department"].select("departmentid", F.col("name").alias("departmentname")),
        "departmentid", "left",
    ).select(same, "departmentname", "startdate", "enddate")
    joined = (
        changed(src["employee"], since)
        .join(person, same, "left")
        .join(seller, same, "left")
        .join(
            src["employeepayhistory"].select(same, F.col("rate").alias("baserate"), "payfrequency"),
            same, "left",
        )
        .join(posts, same, "left")
    )
    moments = ("hiredate", "birthdate", "startdate", "enddate")
    return conform(
        joined.withColumns({
            **{name: calendar.timestamp_or_null(F.col(name)) for name in moments},
            "status": F.when(F.col("enddate").isNotNull(), "Current"),
            "title": F.col("jobtitle"),
            "currentflag": F.col("salariedflag").isNotNull(),
            "emergencycontactname": text.full_name(F.col("firstname"), F.col("lastname")),
            "emergencycontactphone": F.col("phone"),
            "employeenationalidalternatekey": F.col("nationalidnumber"),
        }).na.fill({"namestyle": False, "salespersonflag": False}),
        schemas.DIM_EMPLOYEE,
    )


def customers(src: Tables, since=None, dictionary: DataFrame | None = None) -> DataFrame:
    """Customers with a survey that names birth date, family and income.

    Rows are dropped before the income is read: an income that cannot be read
    stays null.  The address is the one whose id is the customer id, and
    ``geographykey`` is the id of the territory.
    """
    # The survey is read and rows are dropped before any join: no exchange
    # carries the XML text.
    needed = ["birthdate", "maritalstatus", "yearlyincome", "totalchildren", "numberchildrenathome"]
    person = src["person"].filter(F.col("demographics").isNotNull()).drop(
        "persontype", "emailpromotion", "additionalcontactinfo"
    ).withColumnRenamed("businessentityid", "personid")
    surveyed = with_individual_survey(person, "demographics").drop("demographics").na.drop(
        "any", subset=needed
    ).withColumn("yearlyincome", text.income_midpoint(F.col("yearlyincome")))
    email = src["emailaddress"].select(
        F.col("businessentityid").alias("personid"), "emailaddress"
    )
    address = src["address"].select(
        F.col("addressid").alias("customerid"), "addressline1", "addressline2"
    )
    named = (
        changed(src["customer"], since)
        .select("customerid", "personid", "territoryid", "accountnumber")
        .join(surveyed, "personid")
        .join(email, "personid", "left")
        .join(address, "customerid", "left")
        .withColumnsRenamed({"accountnumber": "customeralternatekey", "territoryid": "geographykey"})
    )
    for what in ("education", "occupation"):
        named = _in_languages(named, what, dictionary)
    return conform(named, schemas.DIM_CUSTOMER)


def order_years(src: Tables) -> DataFrame:
    """First and last order year and last order month of each store.

    Orders are summarized per customer before they meet the customers.
    """
    per_customer = src["salesorderheader"].groupBy("customerid").agg(
        F.min("orderdate").alias("first"), F.max("orderdate").alias("last")
    )
    accounts = src["customer"].select("customerid", "storeid")
    return (
        per_customer.join(accounts, "customerid")
        .groupBy("storeid")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select(
            "storeid",
            F.month("last").alias("ordermonth"),
            F.year("first").alias("firstorderyear"),
            F.year("last").alias("lastorderyear"),
        )
    )


def resellers(src: Tables, geography: DataFrame | None, since=None) -> DataFrame:
    """One row per reseller account, its first by change date.

    ``geography`` is the geography dimension with its surrogate key.  The order
    frequency comes from the business type code.
    """
    store = with_store_survey(src["store"].select(
        F.col("businessentityid").alias("storeid"), F.col("name").alias("resellername"),
        "demographics",
    ), "demographics").drop("demographics")
    place = src["businessentityaddress"].select(
        F.col("businessentityid").alias("storeid"), "addressid"
    )
    address = src["address"].select(
        "addressid", "addressline1", "addressline2", "city", "postalcode"
    )
    contact = src["businessentitycontact"].select(
        F.col("businessentityid").alias("storeid"), "personid"
    )
    phone = src["personphone"].select(
        F.col("businessentityid").alias("personid"), F.col("phonenumber").alias("phone")
    )
    # The orders join needs a store; the addresses and contacts need one that exists.
    located = (
        store.join(place, "storeid", "left")
        .join(address, "addressid", "left")
        .join(contact, "storeid", "left")
        .join(phone, "personid", "left")
        .drop("addressid", "personid")
    )
    accounts = (
        changed(src["customer"].filter(F.col("personid").isNull()), since)
        .select("storeid", F.col("accountnumber").alias("reselleralternatekey"), "modifieddate")
    )
    candidates = accounts.join(located, "storeid", "left")
    order = ["modifieddate", "storeid", "resellername", "addressline1", "addressline2", "phone", "city", "postalcode"]
    first = first_per_key(
        candidates, ["reselleralternatekey"], [F.col(name).asc_nulls_last() for name in order]
    )
    typed = first.join(order_years(src), "storeid", "left").withColumns({
        "businesstype": text.business_type(F.col("businesstypecode")),
        "orderfrequency": text.order_frequency(F.col("businesstypecode")),
    })
    return conform(
        lookup_composite(typed, geography, PLACE, "geographykey"), schemas.DIM_RESELLER
    )
