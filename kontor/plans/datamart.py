"""The reseller datamart: one row per dimension key, and a fact with profit."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from kontor.operators.columns import choose_column, find_column, nan_to_null
from kontor.operators.dedupe import first_per_key

# Datamart table -> warehouse table and its key, in any case.
MART_DIMENSIONS = {
    "dm_dimproduct": ("dimproduct", ["ProductKey", "ProductAlternateKey"]),
    "dm_dimreseller": ("dimreseller", ["ResellerKey"]),
    "dm_dimsalesterritory": ("dimsalesterritory", ["SalesTerritoryKey"]),
    "dm_dimemployee": ("dimemployee", ["EmployeeKey"]),
    "dm_dimcurrency": ("dimcurrency", ["CurrencyKey"]),
    "dm_dimpromotion": ("dimpromotion", ["PromotionKey"]),
    "dm_dimdate": ("dimdate", ["DateKey"]),
}
MART_FACT = ("dm_factresellersales", "factresellersales")


def mart_dimension(dimension: DataFrame, candidates: Iterable[str]) -> DataFrame:
    """One row per key; the key is the first candidate present, else the first
    column."""
    return first_per_key(nan_to_null(dimension), [choose_column(dimension, candidates)])


def mart_reseller_sales(fact: DataFrame) -> DataFrame:
    """The fact with sales amount, product cost and profit.

    Amounts the fact has are kept; others are derived where their inputs
    exist, and left out where not.
    """

    def derive(df: DataFrame, name: str, left: str, right: str, combine) -> DataFrame:
        first, second = find_column(df, left), find_column(df, right)
        if first is None or second is None:
            return df
        return df.withColumn(name, combine(first, second))

    measured = fact
    if find_column(fact, "SalesAmount") is None:
        measured = derive(
            measured, "SalesAmount", "ExtendedAmount", "DiscountAmount", lambda a, b: a - b
        )
    if find_column(fact, "TotalProductCost") is None:
        measured = derive(
            measured, "TotalProductCost", "OrderQuantity", "ProductStandardCost", lambda a, b: a * b
        )
    measured = derive(measured, "Profit", "SalesAmount", "TotalProductCost", lambda a, b: a - b)
    return nan_to_null(measured)


def mart_tables(warehouse: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All datamart tables by name."""
    tables = {
        name: mart_dimension(warehouse[table], keys)
        for name, (table, keys) in MART_DIMENSIONS.items()
    }
    tables[MART_FACT[0]] = mart_reseller_sales(warehouse[MART_FACT[1]])
    return tables
