"""One query per operator, table and report, over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.functions import text
from kontor.functions.calendar import date_key
from kontor.functions.survey import with_individual_survey, with_store_survey
from kontor.operators import hierarchy, integrity, loading, numbering, profile
from kontor.operators.columns import conform, since
from kontor.operators.dedupe import latest_per_key
from kontor.operators.lookup import PLACE, lookup_composite, translate
from kontor.operators.reporting import share_of_total
from kontor.plans import datamart, dimensions, facts, finance, reports
from kontor.plans import warehouse as jobs
from kontor.plans.warehouse import Warehouse
from kontor.session import application_folder, configure, stored
from kontor.sources.buckets import bucketed_source, write_orders
from kontor.sources.months import read_by_month, write_by_month
from kontor.sources.retail import RetailSource, RetailStar
from kontor.sources.tables import export_csv, load_tables, read_table, replace_table
from kontor.streaming.incremental import load_stream

LOAD_DATE = dt.date(2026, 1, 1)
HALFWAY = dt.datetime(1998, 1, 1)


def halfway() -> Column:
    return F.lit(str(HALFWAY)).cast("timestamp_ntz")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, for comparison across engines."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder among the results that ``discard_stored`` removes."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


Query = Callable[[RetailSource, RetailStar], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Reports.

def calendar(star: RetailStar) -> DataFrame:
    """Every day from the first to the last order."""
    return dimensions.dates_covering(star.given("orders"), "o_orderdate")


def quarter_region(star: RetailStar) -> DataFrame:
    return reports.sales_by_quarter_region(
        star["factinternetsales"], calendar(star), star["dimsalesterritory"]
    )


def by_month(star: RetailStar) -> DataFrame:
    return reports.sales_by_month(star["factinternetsales"], calendar(star))


def by_channel(star: RetailStar) -> DataFrame:
    return reports.sales_by_channel(star["factinternetsales"], star["factresellersales"])


def by_promotion(star: RetailStar) -> DataFrame:
    return reports.promotions_by_sales(star["factresellersales"], star["dimpromotion"])


def by_store(star: RetailStar) -> DataFrame:
    return reports.store_sales_by_month(
        star["factresellersales"], calendar(star), star["dimreseller"]
    )


@query
def sales_by_quarter_region(src, star):
    return quarter_region(star)


def month_fact(star: RetailStar) -> DataFrame:
    """Internet sales in folders by month."""
    fact = star["factinternetsales"].select("orderdatekey", "salesterritorykey", "salesamount")
    path = scratch(fact.sparkSession, "months")
    write_by_month(fact, path)
    return read_by_month(fact.sparkSession, path, fact.schema)


@query
def second_quarters_by_region(src, star):
    """The fact is laid out by month; the report reads the months of second quarters only."""
    days = stored(calendar(star)).filter("calendarquarter = 2")
    return reports.sales_by_quarter_region(month_fact(star), days, star["dimsalesterritory"])


@query
def sales_pivot_region(src, star):
    """A column for each region that the territories name."""
    named = star["dimsalesterritory"].select("salesterritorygroup").distinct()
    regions = sorted(row[0] for row in named.collect() if row[0] is not None)
    return reports.region_pivot(quarter_region(star), regions)


@query
def region_values(src, star):
    return reports.regions(quarter_region(star))


@query
def region_trend(src, star):
    return reports.region_trend(quarter_region(star))


@query
def sales_by_month(src, star):
    return by_month(star)


@query
def month_trend(src, star):
    return reports.month_trend(by_month(star))


@query
def sales_by_month_all_years(src, star):
    return reports.sales_by_month_all_years(by_month(star))


@query
def sales_by_channel(src, star):
    return by_channel(star)


@query
def channel_share(src, star):
    return reports.channel_share(by_channel(star))


@query
def promotions_by_sales(src, star):
    return by_promotion(star)


@query
def top10_promotions(src, star):
    return reports.top_promotions(by_promotion(star))


@query
def store_sales_month(src, star):
    return by_store(star)


@query
def store_preview(src, star):
    return reports.store_preview(by_store(star))


@query
def top5_stores(src, star):
    return reports.top_stores(by_store(star))


@query
def top5_store_quarters(src, star):
    return reports.top_store_quarters(by_store(star))


@query
def store_quarter_pivot(src, star):
    """Columns are the places 1 to 5 of the stores, the same at every scale."""
    report = by_store(star)
    ranked = Window.orderBy(F.col(reports.SALES).desc(), reports.STORE)
    places = reports.top_stores(report).select(
        reports.STORE,
        F.concat(F.lit("top"), F.row_number().over(ranked).cast("string")).alias("place"),
    )
    quarters = reports.top_store_quarters(report).join(places, reports.STORE)
    renamed = quarters.drop(reports.STORE).withColumnRenamed("place", reports.STORE)
    return reports.store_pivot(renamed, [f"top{n}" for n in range(1, reports.TOP_STORES + 1)])


# Dimensions.

@query
def dim_date(src, star):
    return dimensions.dates_covering(src["salesorderheader"], "orderdate")


@query
def dim_product_category(src, star):
    return dimensions.product_categories(src, dictionary=word_list(src))


@query
def dim_product_subcategory(src, star):
    return dimensions.product_subcategories(src, dictionary=word_list(src))


@query
def dim_product(src, star):
    return dimensions.products(src, dictionary=word_list(src))


@query
def dim_currency(src, star):
    return dimensions.currencies(src)


@query
def dim_promotion(src, star):
    return dimensions.promotions(src)


@query
def dim_sales_reason(src, star):
    return dimensions.sales_reasons(src)


@query
def dim_sales_territory(src, star):
    return dimensions.sales_territories(src)


@query
def dim_geography(src, star):
    return dimensions.geographies(src)


@query
def dim_employee(src, star):
    return dimensions.employees(src, star["dimsalesterritory"])


@query
def latest_employees(src, star):
    """One row per employee: the pay record that sorts last."""
    rows = dimensions.employees(src, star["dimsalesterritory"])
    return latest_per_key(rows, ["employeenationalidalternatekey"], "payfrequency")


@query
def dim_customer(src, star):
    return dimensions.customers(src)


@query
def dim_reseller(src, star):
    return dimensions.resellers(src, star["dimgeography"])


@query
def first_last_order_year(src, star):
    return dimensions.order_years(src)


# Facts.

@query
def fact_internet_sales(src, star):
    return facts.internet_sales(src, star, load_date=LOAD_DATE)


def bucketed(src: RetailSource) -> Mapping[str, DataFrame]:
    """The source with its orders in buckets; orders of more than six lines are apart."""
    spark = src.spark
    prefix = f"orders_{uuid.uuid4().hex}_"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_orders(src, scratch(spark, "buckets"), buckets, prefix, limit=6)
    return bucketed_source(spark, src, prefix)


@query
def fact_internet_sales_bucketed(src, star):
    return facts.internet_sales(bucketed(src), star, load_date=LOAD_DATE)


@query
def fact_reseller_sales_bucketed(src, star):
    return facts.reseller_sales(bucketed(src), star, load_date=LOAD_DATE)


@query
def fact_internet_sales_since(src, star):
    """The load of changed orders."""
    return facts.internet_sales(src, star, since=HALFWAY, load_date=LOAD_DATE)


@query
def fact_reseller_sales_since(src, star):
    return facts.reseller_sales(src, star, since=HALFWAY, load_date=LOAD_DATE)


@query
def fact_reseller_sales(src, star):
    return facts.reseller_sales(src, star, load_date=LOAD_DATE)


@query
def fact_sales_reason(src, star):
    return facts.internet_sales_reasons(src, star, load_date=LOAD_DATE)


@query
def fact_survey_response(src, star):
    return facts.survey_responses(src, star)


@query
def fact_sales_quota(src, star):
    return facts.sales_quotas(src, star)


# The whole way from source tables to reports.

def _loaded(src: RetailSource) -> Warehouse:
    """A new warehouse with all dimensions loaded from the source tables."""
    warehouse = Warehouse(src.spark, scratch(src.spark, "warehouse"))
    days = dimensions.dates_covering(src["salesorderheader"], "orderdate")
    jobs.load_dimensions(src, warehouse, calendar=days)
    return warehouse


@query
def loaded_quarter_region(src, star):
    """Dimensions are loaded, facts look up their keys, and the report reads both.

    The orders come in two loads, of which the second holds all.
    """
    warehouse = _loaded(src)
    early = dict(src.items())
    early["salesorderheader"] = src["salesorderheader"].filter(F.col("orderdate") < halfway())
    jobs.load_internet_sales(early, warehouse, load_date=LOAD_DATE)
    jobs.load_internet_sales(src, warehouse, load_date=LOAD_DATE, gated=False)
    return reports.sales_by_quarter_region(
        warehouse["factinternetsales"], warehouse["dimdate"], warehouse["dimsalesterritory"]
    )


@query
def loaded_reseller_mart(src, star):
    """Reseller sales are loaded, the datamart is refreshed, and summed by reseller."""
    warehouse = _loaded(src)
    jobs.load_reseller_sales(src, warehouse, load_date=LOAD_DATE)
    folder = scratch(src.spark, "datamart")
    jobs.refresh_datamart(warehouse, folder)
    fact = read_table(src.spark, f"{folder}/dm_factresellersales")
    stores = read_table(src.spark, f"{folder}/dm_dimreseller")
    sums = fact.groupBy("resellerkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("salesamount").alias("sales"),
        F.sum("Profit").alias("profit"),
    )
    return sums.join(stores, "resellerkey").select(
        "reselleralternatekey", "resellername", "line_count", "sales", "profit"
    )


# Finance and datamart.

@query
def dim_department(src, star):
    return finance.department_groups(src)


@query
def dim_organization(src, star):
    """With a share that follows from the name."""
    share = F.length(F.regexp_replace("organizationname", " Division$", "")) / F.lit(100.0)
    return finance.organizations(src, star["dimcurrency"], ownership=share)


def _twice(rows: DataFrame, name: str) -> DataFrame:
    """Every row, and again with an older name; which of both comes first differs by row."""
    return rows.unionByName(rows.withColumn(name, F.concat(F.lit("N older "), F.col(name))))


def _mart(table: str, rows: DataFrame) -> DataFrame:
    return datamart.mart_dimension(rows, datamart.MART_DIMENSIONS[f"dm_{table}"][1])


@query
def datamart_dim_product(src, star):
    """Some products have an older row under the same key."""
    rows = dimensions.products(src)
    older = rows.filter("daystomanufacture < 2").withColumn(
        "englishproductname", F.concat(F.lit("m older "), "englishproductname")
    )
    key = F.substring("productalternatekey", 4, 20).cast("bigint") + 1
    return _mart("dimproduct", rows.unionByName(older).withColumn("ProductKey", key))


@query
def datamart_dim_reseller(src, star):
    rows = dimensions.resellers(src, star["dimgeography"])
    key = F.substring("reselleralternatekey", 3, 20).cast("bigint") + 1
    return _mart("dimreseller", _twice(rows, "resellername").withColumn("resellerkey", key))


@query
def datamart_dim_sales_territory(src, star):
    rows = dimensions.sales_territories(src)
    key = F.col("salesterritoryalternatekey") + 1
    return _mart(
        "dimsalesterritory", _twice(rows, "salesterritoryregion").withColumn("salesterritorykey", key))


def currency_number() -> Column:
    """A number for a code of three letters."""
    code = F.col("currencyalternatekey")
    return sum(F.ascii(F.substring(code, at, 1)) * 256 ** (3 - at) for at in (1, 2, 3))


@query
def datamart_dim_currency(src, star):
    rows = dimensions.currencies(src)
    return _mart(
        "dimcurrency", _twice(rows, "currencyname").withColumn("currencykey", currency_number()))


@query
def datamart_dim_promotion(src, star):
    rows = dimensions.promotions(src)
    key = F.col("promotionalternatekey") + 1
    return _mart("dimpromotion", _twice(rows, "englishpromotionname").withColumn("promotionkey", key))


@query
def datamart_dim_date(src, star):
    days = dimensions.dates_covering(src["salesorderheader"], "orderdate")
    return _mart("dimdate", _twice(days, "englishmonthname"))


@query
def datamart_dim_employee(src, star):
    """All posts and pay records, so that keys repeat."""
    employees = dimensions.employees(src, star["dimsalesterritory"]).withColumn(
        "EmployeeKey", F.substring("employeenationalidalternatekey", 4, 20).cast("bigint")
    )
    return _mart("dimemployee", employees)


@query
def datamart_reseller_sales(src, star):
    """The sales amount is taken away, so that it is derived again."""
    fact = facts.reseller_sales(src, star, load_date=LOAD_DATE)
    return datamart.mart_reseller_sales(fact.drop("salesamount"))


# Sources, loading, checks.

def headers(src: RetailSource) -> DataFrame:
    return src["salesorderheader"]


@query
def incremental_scan(src, star):
    return since(headers(src), HALFWAY)


@query
def multi_table_read(src, star):
    """Rows of each given table."""
    names = ["customer", "orders", "lineitem", "events"]
    tables = load_tables(src.spark, names, src.folder)
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, table in tables.items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


@query
def distinct_groups(src, star):
    return src["department"].select("groupname").distinct()


@query
def distinct_territories(src, star):
    return src["salesterritory"].select("territorygroup", "name", "countryregioncode").distinct()


@query
def insert_only_new(src, star):
    """Orders compared by purchase order number, which may be null, and customer."""
    orders = headers(src).select(
        "salesordernumber", "purchaseordernumber", "customerid", "orderdate"
    )
    existing = orders.filter(F.col("orderdate") < halfway())
    return loading.insert_only_new(orders, existing, ["purchaseordernumber", "customerid"])


@query
def warehouse_load(src, star):
    """Earlier orders are loaded, then all: the second load adds the rest."""
    spark = src.spark
    warehouse = Warehouse(spark, scratch(spark, "warehouse"))
    orders = headers(src).select("salesordernumber", "customerid", "taxamt", "orderdate")
    warehouse.load(
        "orders", orders.filter(F.col("orderdate") < halfway()), ["salesordernumber"]
    )
    warehouse.load("orders", orders, ["salesordernumber"])
    return warehouse["orders"]


@query
def warehouse_keys(src, star):
    """Keys of customers loaded in two parts: the first part keeps its keys."""
    spark = src.spark
    warehouse = Warehouse(spark, scratch(spark, "warehouse"))
    renamed = src["customer"].select(
        F.col("accountnumber").alias("customeralternatekey"), "customerid", "storeid"
    )
    warehouse.load("dimcustomer", renamed.filter(F.col("storeid").isNotNull()))
    warehouse.load("dimcustomer", renamed)
    return warehouse["dimcustomer"]


@query
def frame_profile(src, star):
    """What the columns of three tables hold; estimates are left to the tests."""
    parts = [
        profile.profile(profile.sketches(src.given(name))).withColumn("table_name", F.lit(name))
        for name in ("orders", "customer", "lineitem")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        "table_name", "column_name", "rows", "nulls", "least", "largest", "first", "last")


@query
def constrained_load(src, star):
    """Lines loaded in two parts under constraints: rows loaded, and those rejected with reasons.

    Prices are missing where the discount is five percent, some lines come twice, and only
    suppliers of the first ten nations are known.
    """
    spark = src.spark
    lines = src.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_discount") != 0.05, F.col("l_quantity").cast("double")).alias("l_quantity"),
    )
    suppliers = src.given("supplier").filter("s_nationkey < 10").select("s_suppkey", "s_name")
    warehouse = Warehouse(spark, scratch(spark, "constrained"))
    warehouse.load("suppliers", suppliers, ["s_suppkey"])
    rules = integrity.Constraints(
        not_null=["l_quantity"], unique=["l_orderkey", "l_linenumber"],
        references={"l_suppkey": ("suppliers", "s_suppkey")},
    )
    for part in ("l_orderkey % 3 < 2", "l_orderkey % 3 > 0"):
        batch = lines.filter(part)
        again = batch.filter("l_orderkey % 10 = 1")
        warehouse.load("lines", batch.unionByName(again), ["l_orderkey", "l_linenumber"], rules)
    loaded = warehouse["lines"].withColumn("status", F.lit("loaded"))
    rejected = warehouse.rejected("lines").withColumn(
        "status", F.concat_ws("; ", F.lit("rejected"), "reasons")).drop("reasons")
    return loaded.unionByName(rejected)


@query
def watermark_loads(src, star):
    """Orders loaded three times since the watermark, and once more; what each load added."""
    spark = src.spark
    orders = src.given("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    warehouse = Warehouse(spark, scratch(spark, "watermarks"))
    loads = []
    for upto in ("1996-06-30", "1999-01-15", "2099-12-31", "2099-12-31"):
        known = orders.filter(F.col("o_orderdate") <= F.lit(upto).cast(orders.schema["o_orderdate"].dataType))
        added = warehouse.load_since("orders", "erp", known, "o_orderdate", keys=["o_orderkey"])
        loads.append((len(loads) + 1, added, warehouse.watermark("orders", "erp")[:10]))
    done = spark.createDataFrame(loads, "load INT, added BIGINT, watermark STRING")
    total = warehouse["orders"].agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("o_orderkey").alias("sum_of_keys"))
    return done.join(F.broadcast(total))


@query
def changed_orders_load(src, star):
    """All orders but one day's are loaded, then that day's and some whose date has changed."""
    spark = src.spark
    orders = src.given("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("string").substr(1, 10).alias("day"))
    late = orders.filter(F.col("o_orderkey") % 97 == 5)
    changed = orders.filter(F.col("o_orderkey") % 1009 == 7).withColumn("day", F.lit("2030-01-01"))
    warehouse = Warehouse(spark, scratch(spark, "changed"))
    warehouse.load("orders", orders.filter(F.col("o_orderkey") % 97 != 5), ["o_orderkey"])
    warehouse.load("orders", late.unionByName(changed), ["o_orderkey"])
    return warehouse["orders"]


@query
def full_replace(src, star):
    spark = src.spark
    path = scratch(spark, "replace")
    replace_table(src["product"].limit(0), path)
    replace_table(src["customer"].select("customerid", "accountnumber"), path)
    replace_table(src["customer"].select("customerid", "storeid", "accountnumber"), path)
    replace_table(src["customer"].select("customerid", "accountnumber").limit(0), path)
    return read_table(spark, path)


@query
def csv_roundtrip(src, star):
    spark = src.spark
    written = src["product"].select("productid", "name", "color", "listprice", "finishedgoodsflag")
    path = export_csv(written, "products", scratch(spark, "csv"), sep=";")
    return spark.read.csv(path, header=True, sep=";", escape='"', schema=written.schema)


@query
def stream_insert_only_new(src, star):
    """Events arrive as a stream, some are loaded already."""
    events = src.given("events")
    spark = src.spark
    warehouse = Warehouse(spark, scratch(spark, "stream"))
    warehouse.load("events", events.filter(F.col("event_type") == "view"), ["event_id"])
    arriving = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet").parquet(src.folder)
    )
    load_stream(
        arriving, warehouse, "events", scratch(spark, "offsets"), ["event_id"]
    ).awaitTermination()
    return warehouse["events"]


@query
def has_new_fact_data(src, star):
    """The gate of the orders, with the load date as a share of the history."""
    loaded = headers(src).withColumn("saved", F.to_date(halfway()))
    return loading.load_gate(loaded)


@query
def source_is_newer(src, star):
    orders = headers(src)
    loaded = orders.filter(F.col("orderdate") < halfway())
    return loading.source_gate(orders, loaded, "modifieddate")


@query
def has_any_row(src, star):
    empty = loading.needs_first_load(src.given("events"))
    return src.given("events").agg(F.lit(empty).alias("needs_load"))


@query
def pk_violations(src, star):
    return integrity.pk_violations(src.given("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def not_null_violations(src, star):
    return integrity.null_violations(headers(src), headers(src).columns)


@query
def fk_orphans(src, star):
    return integrity.fk_orphans(
        src["salespersonquotahistory"], "businessentityid", src["salesperson"], "businessentityid"
    )


# Keys, numbers, lookups.

@query
def surrogate_keys(src, star):
    customers = src.given("customer")
    order = [F.col("c_mktsegment"), F.col("c_acctbal").desc()]
    return numbering.assign_keys(customers, order, "customerkey", start=100)


@query
def surrogate_keys_of_copies(src, star):
    """Keys of rows most of which are equal."""
    return numbering.assign_keys(
        src.given("lineitem").select("l_returnflag", "l_linestatus"),
        [F.col("l_returnflag")], "linekey",
    )


@query
def line_numbers(src, star):
    lines = src.given("lineitem")
    order = [name for name in lines.columns if name != "l_orderkey"]
    return numbering.line_number(lines, ["l_orderkey"], order, "line")


@query
def line_numbers_large_groups(src, star):
    """Three groups hold all rows; each is numbered across tasks."""
    lines = src.given("lineitem")
    order = [F.col(name) for name in lines.columns if name != "l_returnflag"]
    return numbering.number_within(lines, ["l_returnflag"], order, "line")


@query
def parent_accounts(src, star):
    """Customers with the key of their store's account, by a join with themselves."""
    accounts = src["customer"].select(
        "customerid", "accountnumber",
        F.when(F.col("personid").isNotNull(), F.concat(F.lit("RS"), F.col("storeid").cast("string")))
        .alias("parentnumber"),
    )
    return hierarchy.parent_key(accounts, "parentnumber", "accountnumber", "customerid", "parentid")


@query
def dedupe_composite(src, star):
    """Geography keys of addresses by city and postal code, written otherwise."""
    addresses = src["address"].select(
        "addressid", F.concat(F.lit("  "), F.upper("city"), F.lit(" ")).alias("city"),
        F.concat("postalcode", F.lit(" ")).alias("postalcode"),
    )
    return lookup_composite(addresses, star["dimgeography"], PLACE, "geographykey").select(
        "addressid", "geographykey"
    )


def word_list(src: RetailSource) -> DataFrame:
    """Translations of some product names and types."""
    parts = src.given("part")
    names = parts.select(F.col("p_name").alias("text"), "p_size")
    types = parts.select(F.col("p_type").alias("text"), F.lit(1).alias("p_size"))
    words = names.unionByName(types).filter(
        F.col("text").contains("l") | F.col("text").contains("L")
    ).select("text").distinct()
    spanish = words.select("text", F.lit("es").alias("lang"), F.concat(F.lit("es "), "text").alias("translated"))
    french = words.filter(~F.col("text").contains("bolt")).select(
        "text", F.lit("fr").alias("lang"), F.concat(F.lit("fr "), "text").alias("translated")
    )
    return spanish.unionByName(french)


@query
def translate_with_fallback(src, star):
    parts = src.given("part").select("p_partkey", "p_name")
    return translate(parts, "p_name", {"fr": "french_name"}, word_list(src))


# Expressions.

def _surveys(src: RetailSource) -> DataFrame:
    return src["person"].select("businessentityid", "demographics")


@query
def individual_survey(src, star):
    return with_individual_survey(_surveys(src), "demographics").drop("demographics")


@query
def store_survey(src, star):
    stores = src["store"].select("businessentityid", "demographics")
    return with_store_survey(stores, "demographics").drop("demographics")


@query
def income_midpoint(src, star):
    surveyed = with_individual_survey(_surveys(src), "demographics")
    return surveyed.select(
        "businessentityid", text.income_midpoint(F.col("yearlyincome")).alias("income")
    )


@query
def person_names(src, star):
    return src["person"].select(
        "businessentityid", text.full_name(F.col("firstname"), F.col("lastname")).alias("name")
    )


@query
def business_types(src, star):
    code = F.when(F.col("s_acctbal") < 0, F.lit(None)).when(
        F.col("s_acctbal") < 2500, F.lit(" OS ")
    ).when(F.col("s_acctbal") < 5000, F.lit("BS")).when(
        F.col("s_acctbal") < 7500, F.lit("BM")
    ).otherwise(F.lit("ZZ"))
    return src.given("supplier").select(
        "s_suppkey", text.business_type(code).alias("business_type"),
        text.order_frequency(code).alias("order_frequency"),
    )


@query
def money_values(src, star):
    written = F.when(F.col("c_acctbal") < 0, F.lit("none")).otherwise(
        F.concat(F.lit("$1,"), F.col("c_custkey").cast("string"), F.lit(".5"))
    )
    return src.given("customer").select("c_custkey", text.money(written).alias("amount"))


@query
def date_keys(src, star):
    return src.given("events").select("event_id", date_key(F.col("ts")).alias("datekey"))


@query
def segment_share(src, star):
    """Share of the orders' value by customer segment."""
    per_customer = src.given("orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("value")
    )
    joined = per_customer.join(src.given("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return share_of_total(
        joined.groupBy("c_mktsegment").agg(F.sum("value").alias("value")), "value"
    )


@query
def fixed_layout(src, star):
    """Given columns in a new order and type, a missing one as null."""
    return conform(
        src.given("supplier"), "s_name STRING, s_suppkey INT, s_acctbal DECIMAL(15,2), s_fax STRING"
    )


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return plain(QUERIES[name](RetailSource(spark, folder), RetailStar(spark, folder)))
