"""Finance dimensions: departments, organizations, scenarios, accounts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor import schemas
from kontor.operators.columns import conform
from kontor.operators.hierarchy import division_tree, with_root
from kontor.operators.lookup import lookup_key

Tables = Mapping[str, DataFrame]

# Fixed values.
ROOT_DEPARTMENT = "Corporate"
SCENARIOS = [(1, "Actual"), (2, "Budget"), (3, "Forecast")]
ACCOUNTS = [
    (1, None, "1000", "Cash", "Asset", "Actual", "Current Assets"),
    (2, 1, "1010", "Checking Account", "Asset", "Actual", "Current Assets"),
    (3, 1, "1020", "Savings Account", "Asset", "Actual", "Current Assets"),
    (4, None, "1100", "Accounts Receivable", "Asset", "Actual", "Current Assets"),
    (5, 4, "1110", "Trade Receivables", "Asset", "Actual", "Current Assets"),
    (6, None, "2000", "Accounts Payable", "Liability", "Actual", "Current Liabilities"),
    (7, 6, "2010", "Vendor Payables", "Liability", "Actual", "Current Liabilities"),
    (8, None, "3000", "Operating Expenses", "Expense", "Actual", "Expenses"),
    (9, 8, "3100", "Salaries Expense", "Expense", "Actual", "Expenses"),
    (10, 8, "3200", "Rent Expense", "Expense", "Actual", "Expenses"),
    (11, None, "4000", "Sales Revenue", "Revenue", "Actual", "Revenue"),
    (12, 11, "4100", "Online Sales Revenue", "Revenue", "Actual", "Revenue"),
]


def department_groups(src: Tables) -> DataFrame:
    """Distinct department groups below one root."""
    groups = src["department"].select(F.col("groupname").alias("departmentgroupname")).distinct()
    tree = with_root(
        groups, "departmentgroupname", ROOT_DEPARTMENT,
        "departmentgroupkey", "parentdepartmentgroupkey",
    )
    return conform(tree, schemas.DIM_DEPARTMENT_GROUP)


def seeded_share(seed: int, *columns: Column) -> Column:
    """A share in [0, 1) that depends on the row and the seed only."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1_000_000)) / 1_000_000


def organizations(
    src: Tables,
    currencies: DataFrame | None = None,
    ownership: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """A division per sales territory with the territory below it.

    A division has an ownership share (``ownership``, or a seeded number) and
    the currency of its country; of several currencies the first by code.
    """
    territories = src["salesterritory"].select(
        F.col("name").alias("organizationname"), "territorygroup", "countryregioncode"
    ).distinct()
    country_currency = src["countryregioncurrency"].groupBy("countryregioncode").agg(
        F.min("currencycode").alias("currency_bk")
    )
    tree = division_tree(
        territories, "organizationname", "organizationkey", "parentorganizationkey"
    ).join(country_currency, "countryregioncode", "left")
    keyed = lookup_key(tree, currencies, "currency_bk", "currencyalternatekey", "currencykey")
    share = seeded_share(seed, F.col("organizationname")) if ownership is None else ownership
    return conform(keyed.withColumns({
        "percentageofownership": F.when(F.col("is_division"), share),
        "currencykey": F.when(F.col("is_division"), F.col("currencykey")),
    }), schemas.DIM_ORGANIZATION)


def scenarios(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCENARIOS, schemas.DIM_SCENARIO)


def accounts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACCOUNTS, schemas.DIM_ACCOUNT)
