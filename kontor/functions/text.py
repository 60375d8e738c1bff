"""Text expressions: names, money, income bands, code labels, period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
WHITESPACE = " \t\n\r\x0b\x0c"
TOP_INCOME = 130000.0
BUSINESS_TYPES = {"OS": "Warehouse", "BS": "Specialty Bike Shop", "BM": "Value Added Reseller"}
ORDER_FREQUENCIES = {"BM": "S", "BS": "A", "OS": "Q"}


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def normalized(column: Column) -> Column:
    """Trimmed lower-case form used to compare names."""
    return F.lower(strip(column))


def full_name(first: Column, last: Column) -> Column:
    """First and last name around one space; a missing part counts as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def money(column: Column) -> Column:
    """Number behind text such as ``$1,000.50``; null when it is none."""
    return F.regexp_replace(column, "[$,]", "").try_cast("double")


def income_midpoint(band: Column) -> Column:
    """Middle of an income band such as ``25001-50000``.

    The open top band has a fixed value; anything else is null.
    """
    text = normalized(band)
    bounds = F.split(F.regexp_replace(text, "[$,]", ""), "-")
    low = strip(F.get(bounds, F.lit(0))).try_cast("bigint")
    high = strip(F.get(bounds, F.lit(1))).try_cast("bigint")
    return F.when(text.startswith("greater than"), F.lit(TOP_INCOME)).when(
        text.contains("-"), (low + high) / 2
    )


def _code_map(codes: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in codes.items() for part in pair])


def business_type(code: Column) -> Column:
    """Label of a business type code; an unknown code stays as it is."""
    return F.coalesce(F.try_element_at(_code_map(BUSINESS_TYPES), strip(code)), code)


def order_frequency(code: Column) -> Column:
    """Ordering rhythm of a business type code; null for an unknown code."""
    return F.try_element_at(_code_map(ORDER_FREQUENCIES), strip(code))


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def month_label(year: Column, month_name: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), month_name)
