"""Sales reports on the star schema.

Facts are summed on their own keys before they meet a dimension that can be
large, so a hot store is one row per task in the join.  The calendar is a few
thousand rows and joins first.  Result columns keep the names their users know.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.functions.text import month_label, quarter_label
from kontor.operators.reporting import pivot_report, share_of_total, top_n
from kontor.sources.months import MONTH as ORDER_MONTH, month_of

# Result columns and channel names.
YEAR, QUARTER, MONTH, MONTH_NAME = "año", "trimestre", "mes", "nombre_mes"
REGION, CHANNEL, STORE, PERIOD = "region_mundo", "canal", "tienda", "periodo"
PROMOTION, KIND, CATEGORY = "promocion", "tipo", "categoria"
SALES, SHARE = "total_ventas", "porcentaje"
INTERNET, STORES = "Internet", "Tiendas/Reseller"
TOP_PROMOTIONS, TOP_STORES, PREVIEW_ROWS = 10, 5, 5


def _sales(df: DataFrame, *keys: str, amount: str = SALES) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(amount).alias(SALES))


def _ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def _on_calendar(
    fact: DataFrame, dates: DataFrame, attributes: dict[str, str], *keys: str
) -> DataFrame:
    """Sales per key and calendar attribute (``attribute: result column``).

    A fact laid out by month meets the calendar by month as well, and with only some days
    in ``dates`` no other month is read.
    """
    on = ["orderdatekey"]
    days = dates.select(
        F.col("datekey").alias("orderdatekey"),
        *[F.col(name).alias(alias) for name, alias in attributes.items()],
    )
    if ORDER_MONTH in fact.columns:
        on.append(ORDER_MONTH)
        days = days.withColumn(ORDER_MONTH, month_of("orderdatekey"))
    daily = _sales(fact, *on, *keys, amount="salesamount")
    return _sales(daily.join(days, on), *attributes.values(), *keys)


def sales_by_quarter_region(
    fact: DataFrame, dates: DataFrame, territories: DataFrame
) -> DataFrame:
    """Internet sales by year, quarter and world region."""
    quarterly = _on_calendar(
        fact, dates, {"calendaryear": YEAR, "calendarquarter": QUARTER}, "salesterritorykey"
    )
    regions = territories.select(
        "salesterritorykey", F.col("salesterritorygroup").alias(REGION)
    )
    total = _sales(quarterly.join(regions, "salesterritorykey"), YEAR, QUARTER, REGION)
    return total.orderBy(*_ascending(YEAR, QUARTER, REGION))


def region_pivot(report: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Quarters as rows, regions as columns; no sales stay null."""
    return pivot_report(report, [YEAR, QUARTER], REGION, SALES, regions)


def regions(report: DataFrame) -> DataFrame:
    return report.select(REGION).distinct()


def region_trend(report: DataFrame, region: str | None = None) -> DataFrame:
    """Sales per labelled quarter of one region, or of each."""
    rows = report if region is None else report.filter(F.col(REGION) == F.lit(region))
    label = quarter_label(F.col(YEAR), F.col(QUARTER))
    return rows.select(REGION, label.alias(PERIOD), SALES).orderBy(*_ascending(REGION, PERIOD))


def sales_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Internet sales by year and month."""
    total = _on_calendar(fact, dates, {
        "calendaryear": YEAR, "monthnumberofyear": MONTH, "englishmonthname": MONTH_NAME,
    })
    return total.orderBy(*_ascending(YEAR, MONTH))


def month_trend(report: DataFrame) -> DataFrame:
    """Sales per labelled month, in calendar order."""
    label = month_label(F.col(YEAR), F.col(MONTH_NAME))
    return report.orderBy(*_ascending(YEAR, MONTH)).select(label.alias(PERIOD), SALES)


def sales_by_month_all_years(report: DataFrame) -> DataFrame:
    """Sales by month over all years."""
    return _sales(report, MONTH, MONTH_NAME).orderBy(*_ascending(MONTH))


def sales_by_channel(internet: DataFrame, resellers: DataFrame) -> DataFrame:
    """Total of each channel; null for one without sales."""

    def total(fact: DataFrame, channel: str) -> DataFrame:
        return fact.agg(F.sum("salesamount").alias(SALES)).select(
            F.lit(channel).alias(CHANNEL), SALES
        )

    return total(internet, INTERNET).unionByName(total(resellers, STORES))


def channel_share(report: DataFrame) -> DataFrame:
    """Percentage of each channel."""
    return share_of_total(report, SALES, SHARE)


def promotions_by_sales(fact: DataFrame, promotions: DataFrame) -> DataFrame:
    """Reseller sales by promotion, largest first."""
    named = promotions.select(
        "promotionkey",
        F.col("englishpromotionname").alias(PROMOTION),
        F.col("englishpromotiontype").alias(KIND),
        F.col("englishpromotioncategory").alias(CATEGORY),
    )
    per_key = _sales(fact, "promotionkey", amount="salesamount")
    total = _sales(per_key.join(named, "promotionkey"), PROMOTION, KIND, CATEGORY)
    return total.orderBy(F.col(SALES).desc_nulls_first(), *_ascending(PROMOTION, KIND, CATEGORY))


def top_promotions(report: DataFrame, n: int = TOP_PROMOTIONS) -> DataFrame:
    return top_n(report, SALES, n, [PROMOTION, KIND, CATEGORY])


def store_sales_by_month(
    fact: DataFrame, dates: DataFrame, resellers: DataFrame
) -> DataFrame:
    """Reseller sales by month and store, the largest store of a month first."""
    monthly = _on_calendar(fact, dates, {
        "calendaryear": YEAR, "calendarquarter": QUARTER, "englishmonthname": MONTH,
        "monthnumberofyear": "monthnumberofyear",
    }, "resellerkey")
    stores = resellers.select("resellerkey", F.col("resellername").alias(STORE))
    total = _sales(
        monthly.join(stores, "resellerkey"), YEAR, QUARTER, MONTH, "monthnumberofyear", STORE
    )
    return total.orderBy(
        *_ascending(YEAR, QUARTER, "monthnumberofyear"),
        F.col(SALES).desc_nulls_first(), *_ascending(STORE),
    )


def store_preview(report: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First rows of the store report."""
    return report.limit(n)


def top_stores(report: DataFrame, n: int = TOP_STORES) -> DataFrame:
    """Stores with the largest sales of all time."""
    return top_n(_sales(report, STORE), SALES, n, [STORE])


def top_store_quarters(report: DataFrame, n: int = TOP_STORES) -> DataFrame:
    """Quarterly sales of the top stores."""
    quarterly = _sales(report, YEAR, QUARTER, STORE)
    kept = quarterly.join(top_stores(report, n), STORE, "left_semi")
    return kept.withColumn(PERIOD, quarter_label(F.col(YEAR), F.col(QUARTER)))


def store_pivot(quarters: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """Quarters as rows, stores as columns; no sales are 0."""
    return pivot_report(quarters, [YEAR, QUARTER, PERIOD], STORE, SALES, stores, fill=0)
