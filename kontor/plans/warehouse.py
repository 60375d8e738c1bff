"""A warehouse of Parquet tables and the jobs that load it."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.columns import since
from kontor.operators.integrity import Constraints, checked
from kontor.operators.loading import has_new_fact_data, insert_only_new
from kontor.operators.numbering import assign_keys
from kontor.plans import datamart, dimensions, facts, finance
from kontor.session import discarding
from kontor.sources.tables import replace_table
from kontor.sources.versions import Table, in_ranges, sorts_as_text

Tables = Mapping[str, DataFrame]

# The key that makes a row known, per table.
LOAD_KEYS = {
    "dimdate": ["datekey"],
    "dimproductcategory": ["productcategoryalternatekey"],
    "dimproductsubcategory": ["productsubcategoryalternatekey"],
    "dimproduct": ["productalternatekey"],
    "dimsalesterritory": ["salesterritoryalternatekey"],
    "dimgeography": ["city", "postalcode"],
    "dimcustomer": ["customeralternatekey"],
    "dimpromotion": ["promotionalternatekey"],
    "dimcurrency": ["currencyalternatekey"],
    "dimemployee": ["employeenationalidalternatekey"],
    "dimreseller": ["reselleralternatekey"],
    "dimsalesreason": ["salesreasonalternatekey"],
    "factinternetsales": ["salesordernumber", "salesorderlinenumber"],
    "factinternetsalesreason": ["salesordernumber", "salesorderlinenumber", "salesreasonkey"],
    "factsurveyresponse": ["datekey", "customerkey", "productcategorykey", "productsubcategorykey"],
    "factsalesquota": ["employeekey", "datekey"],
    "factresellersales": ["salesordernumber", "salesorderlinenumber"],
    "dimscenario": ["scenariokey"],
    "dimaccount": ["accountalternatekey"],
    "dimdepartmentgroup": ["departmentgroupname"],
    "dimorganization": ["organizationname"],
}
# Tables whose surrogate key the load assigns.
SURROGATE_KEYS = {
    "dimproductcategory": "productcategorykey",
    "dimproductsubcategory": "productsubcategorykey",
    "dimproduct": "productkey",
    "dimsalesterritory": "salesterritorykey",
    "dimgeography": "geographykey",
    "dimcustomer": "customerkey",
    "dimpromotion": "promotionkey",
    "dimcurrency": "currencykey",
    "dimemployee": "employeekey",
    "dimreseller": "resellerkey",
    "dimsalesreason": "salesreasonkey",
}


@dataclass(frozen=True)
class Loaded:
    """What a load did: rows added and rejected, files of the table before, and those it opened."""

    rows: int
    rejected: int = 0
    files: int = 0
    opened: int = 0


class Warehouse(Mapping):
    """Versioned Parquet tables below one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        #: The last load of each table.
        self.loads: dict[str, Loaded] = {}

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.folder}/{name}")

    def get(self, name: str, default: DataFrame | None = None) -> DataFrame | None:
        """The table as it is now, or ``default`` before its first load."""
        found = self.table(name).read()
        return default if found is None else found

    def __getitem__(self, name: str) -> DataFrame:
        found = self.get(name)
        if found is None:
            raise KeyError(name)
        return found

    def __contains__(self, name: object) -> bool:
        return bool(self.table(str(name)).versions())

    def __iter__(self) -> Iterator[str]:
        return (name for name in LOAD_KEYS if name in self)

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def load(
        self, name: str, batch: DataFrame, keys: Sequence[str] | None = None,
        rules: Constraints | None = None, watermarks: Mapping[str, str] | None = None,
    ) -> int:
        """Append the rows of ``batch`` whose key is new; returns their number.

        A surrogate key continues behind the largest one of the table; rows
        already there keep theirs.  Rows that break ``rules`` go to the rejected rows of the
        table in the same pass, whether their key is new or not.  ``watermarks`` are kept with
        the load.  All of this is one commit.
        """
        with discarding(self.spark):
            done = self._load(
                name, batch, LOAD_KEYS[name] if keys is None else keys, rules, watermarks or {})
        self.loads[name] = done
        return done.rows

    def _load(self, name: str, batch: DataFrame, keys: Sequence[str], rules, watermarks) -> Loaded:
        table = self.table(name)
        before = table.state()
        surrogate = SURROGATE_KEYS.get(name)
        if surrogate is not None:
            batch = self._keyed(table, before, batch, keys, surrogate)
        elif before is not None:
            batch = _as_table(batch, before)
        # Keys of a dimension are in order already, and they are not looked up again.
        key = surrogate or keys[0]
        # Rows with one key are found where the ranges of keys lie that are written.
        ranged = surrogate is None and rules is not None and key in rules.unique
        if rules is None:
            rows = batch
        elif ranged:
            rows = checked(batch, rules, self, place=lambda found: in_ranges(found, key))
        else:
            rows = checked(batch, rules, self)
        folder, staged, rejects = table.stage(rows, key, sort=surrogate is None, spread=not ranged)
        opened: set[str] = set()
        files = table.files(before).collect() if before else []
        if surrogate is None and files and staged:
            schema = T.StructType.fromJson(before["schema"])
            hits = table.hits(staged, files, key, schema)
            opened = set().union(*hits.values()) if hits else set()
            if hits:
                # Only these rows can be known; the files of all others stay as they are.
                doubtful = table.rows_of([row["path"] for row in staged if row["path"] in hits], schema)
                known = table.rows_of(sorted(opened), schema)
                if sorts_as_text(schema[key].dataType):
                    _, fresh, _ = table.stage(_new_in_ranges(doubtful, known, keys), key, spread=False)
                else:
                    _, fresh, _ = table.stage(insert_only_new(doubtful, known, keys), key)
                staged = [row for row in staged if row["path"] not in hits] + fresh
        added = sum(row["rows"] for row in staged)
        rejected = sum(row["rows"] for row in rejects)
        if before is None or added or rejected or watermarks:
            table.commit(before, {
                "schema": before["schema"] if before else json.loads(batch.schema.json()),
                "lists": (before["lists"] if before else []) + table.listed(staged),
                "rejects": (before["rejects"] if before else []) + table.listed(rejects),
                "watermarks": (before["watermarks"] if before else {}) | dict(watermarks),
            })
        if not added and not rejected:
            table.drop(folder)
        return Loaded(added, rejected, len(files), len(opened))

    def _keyed(self, table, before, batch: DataFrame, keys: Sequence[str], surrogate: str) -> DataFrame:
        existing = None if before is None else table.read()
        fresh = insert_only_new(batch, existing, keys)
        last = None if existing is None else existing.agg(F.max(surrogate)).first()[0]
        order = [F.col(key).asc_nulls_last() for key in keys]
        return assign_keys(fresh, order, surrogate, (last or 0) + 1)

    def rejected(self, name: str) -> DataFrame:
        """The rows that loads have rejected, with ``reasons``."""
        found = self.table(name).rejected()
        if found is None:
            raise KeyError(name)
        return found

    def watermark(self, name: str, source: str) -> str | None:
        """How far the loads of a table have read a source."""
        state = self.table(name).state()
        return state["watermarks"].get(source) if state else None

    def load_since(
        self, name: str, source: str, rows: DataFrame, column: str = "modifieddate",
        build: Callable[[DataFrame], DataFrame] = lambda changed: changed,
        keys: Sequence[str] | None = None, rules: Constraints | None = None,
    ) -> int:
        """Load what has changed in ``rows`` since the last such load, and keep how far it came.

        The watermark is the newest ``column`` read, and is committed with the load: one that
        fails is read again.  Rows as new as the watermark are read again too, and known by key.
        """
        changed = since(rows, self.watermark(name, source), column)
        newest = changed.agg(F.max(column).cast("string")).first()[0]
        # Rows that arrive meanwhile are left to the next load.
        upto = changed if newest is None else changed.filter(
            F.col(column) <= F.lit(newest).cast(rows.schema[column].dataType))
        marks = {} if newest is None else {source: newest}
        if marks.get(source) == self.watermark(name, source):
            marks = {}
        return self.load(name, build(upto), keys, rules, marks)

    def gate(self, fact: str, date: str = "orderdate") -> bool:
        """Whether the fact should be loaded, by the dates it holds."""
        return has_new_fact_data(self.get(fact), date=date)


def _new_in_ranges(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``insert_only_new`` of rows in the types of the table, in ranges of the first key.

    Rows and known keys are exchanged once, for the ranges that are written.
    """
    known = existing.select(*keys).withColumn("_known", F.lit(True))
    both = batch.withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    held = F.max("_known").over(Window.partitionBy(*keys))
    return in_ranges(both, keys[0]).withColumn("_held", held).filter(~F.col("_held")).select(*batch.columns)


def _as_table(batch: DataFrame, state: dict) -> DataFrame:
    """``batch`` in the columns and types of the table."""
    schema = T.StructType.fromJson(state["schema"])
    extra = {name.lower() for name in batch.columns} - {name.lower() for name in schema.names}
    if extra:
        raise ValueError(f"the table has no columns {sorted(extra)}")
    held = {name.lower() for name in batch.columns}
    return batch.select(*[
        (F.col(f"`{field.name}`") if field.name.lower() in held else F.lit(None))
        .cast(field.dataType).alias(field.name) for field in schema
    ])


def load_dimensions(
    src: Tables,
    warehouse: Warehouse,
    since=None,
    calendar: DataFrame | None = None,
    dictionary: DataFrame | None = None,
) -> dict[str, int]:
    """Load all sales dimensions, parents before the tables that look them up.

    The calendar is the usual one, longer if there are orders outside it.
    """
    days = calendar
    if days is None:
        days = dimensions.dates_including(src["salesorderheader"], "orderdate")
    loaded = {"dimdate": warehouse.load("dimdate", days)}

    def load(name: str, rows: DataFrame) -> None:
        loaded[name] = warehouse.load(name, rows)

    load("dimproductcategory", dimensions.product_categories(src, since, dictionary))
    load("dimproductsubcategory", dimensions.product_subcategories(src, since, dictionary))
    load("dimproduct", dimensions.products(src, since, dictionary))
    load("dimsalesterritory", dimensions.sales_territories(src, since))
    load("dimgeography", dimensions.geographies(src, since))
    load("dimcustomer", dimensions.customers(src, since))
    load("dimpromotion", dimensions.promotions(src, since))
    load("dimcurrency", dimensions.currencies(src, since))
    load("dimemployee", dimensions.employees(src, warehouse["dimsalesterritory"], since))
    load("dimreseller", dimensions.resellers(src, warehouse["dimgeography"], since))
    load("dimsalesreason", dimensions.sales_reasons(src, since))
    return loaded


def load_internet_sales(
    src: Tables, warehouse: Warehouse, since=None, load_date: dt.date | None = None,
    gated: bool = True,
) -> int:
    """Load internet sales, by default if their gate is open."""
    if gated and not warehouse.gate("factinternetsales"):
        return 0
    return warehouse.load(
        "factinternetsales", facts.internet_sales(src, warehouse, since, load_date)
    )


def load_internet_sales_reasons(
    src: Tables, warehouse: Warehouse, since=None, load_date: dt.date | None = None,
    gated: bool = True,
) -> int:
    """Load sales reasons, by default if the gate of the internet sales is open.

    Loading internet sales shuts that gate, so the reasons go first.
    """
    if gated and not warehouse.gate("factinternetsales"):
        return 0
    return warehouse.load(
        "factinternetsalesreason", facts.internet_sales_reasons(src, warehouse, since, load_date)
    )


def load_reseller_sales(
    src: Tables, warehouse: Warehouse, since=None, load_date: dt.date | None = None,
    gated: bool = True,
) -> int:
    """Load reseller sales, by default if their gate is open."""
    if gated and not warehouse.gate("factresellersales"):
        return 0
    return warehouse.load(
        "factresellersales", facts.reseller_sales(src, warehouse, since, load_date)
    )


def load_survey_responses(
    src: Tables, warehouse: Warehouse, since=None, gated: bool = True
) -> int:
    """Load survey responses.  The fact has no load date, so its gate stays shut
    after the first load."""
    if gated and not warehouse.gate("factsurveyresponse", date="date"):
        return 0
    return warehouse.load("factsurveyresponse", facts.survey_responses(src, warehouse, since))


def load_sales_quotas(
    src: Tables, warehouse: Warehouse, since=None, gated: bool = True
) -> int:
    """Load sales quotas; gated as the survey responses."""
    if gated and not warehouse.gate("factsalesquota", date="date"):
        return 0
    return warehouse.load("factsalesquota", facts.sales_quotas(src, warehouse, since))


def load_finance(src: Tables, warehouse: Warehouse) -> dict[str, int]:
    """Load the finance dimensions."""
    spark = warehouse.spark
    tables = {
        "dimcurrency": dimensions.currencies(src),
        "dimscenario": finance.scenarios(spark),
        "dimaccount": finance.accounts(spark),
        "dimdepartmentgroup": finance.department_groups(src),
    }
    loaded = {name: warehouse.load(name, rows) for name, rows in tables.items()}
    loaded["dimorganization"] = warehouse.load(
        "dimorganization", finance.organizations(src, warehouse["dimcurrency"])
    )
    return loaded


def refresh_datamart(warehouse: Warehouse, folder: str) -> dict[str, int]:
    """Replace every datamart table; one that would be empty is left alone."""
    origin = {name: table for name, (table, _) in datamart.MART_DIMENSIONS.items()}
    origin[datamart.MART_FACT[0]] = datamart.MART_FACT[1]
    return {
        name: replace_table(rows, f"{folder.rstrip('/')}/{name}", probe=warehouse[origin[name]])
        for name, rows in datamart.mart_tables(warehouse).items()
    }
