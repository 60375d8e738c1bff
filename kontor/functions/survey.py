"""XML survey documents as columns.

Surveys are told apart by namespaces: of elements, of prefixes, of documents that
declare them at some inner element.  Spark's XML functions don't resolve
namespaces, so documents pass a parser that does, in Arrow batches, once per row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.functions.text import money

# The parsers travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The namespace of individual surveys, and element -> column.
INDIVIDUAL_NAMESPACE = (
    "http://schemas.microsoft.com/sqlserver/2004/07/adventure-works/IndividualSurvey"
)
INDIVIDUAL_FIELDS = {
    "BirthDate": "birthdate",
    "MaritalStatus": "maritalstatus",
    "YearlyIncome": "yearlyincome",
    "Gender": "gender",
    "TotalChildren": "totalchildren",
    "NumberChildrenAtHome": "numberchildrenathome",
    "Education": "englisheducation",
    "Occupation": "englishoccupation",
    "HomeOwnerFlag": "houseownerflag",
    "NumberCarsOwned": "numbercarsowned",
    "CommuteDistance": "commutedistance",
    "DateFirstPurchase": "datefirstpurchase",
}

# Ending of an element's name -> field of a store survey.
STORE_FIELDS = {
    "annualrevenue": "annualrevenue",
    "yearopened": "yearopened",
    "bankname": "bankname",
    "annualsales": "annualsales",
    "numberemployees": "numberemployees",
    "specialty": "productline",
    "productline": "productline",
    "businesstype": "businesstypecode",
}


def _root(document: str | None) -> ElementTree.Element | None:
    """The root of a well-formed document, else None."""
    if not document:
        return None
    try:
        return ElementTree.fromstring(document)
    except (ElementTree.ParseError, ValueError, LookupError):
        return None


def _children(document: str | None) -> dict[str, str]:
    """Text of the direct children in the survey's namespace, of each name the first."""
    found: dict[str, str] = {}
    root = _root(document)
    for child in root if root is not None else ():
        space, _, name = child.tag[1:].rpartition("}")
        if space == INDIVIDUAL_NAMESPACE:
            found.setdefault(name, child.text or "")
    return found


def _endings(document: str | None) -> dict[str, str]:
    """Last text that isn't blank of the elements at any depth, by ending of the name."""
    found: dict[str, str] = {}
    root = _root(document)
    for element in root.iter() if root is not None else ():
        text = (element.text or "").strip()
        name = element.tag.lower()
        field = next((field for end, field in STORE_FIELDS.items() if name.endswith(end)), None)
        if text and field:
            found[field] = text
    return found


def _parsed(df: DataFrame, xml: str, parse, keys: dict[str, str]) -> DataFrame:
    """Adds a text column for each of ``keys`` (key of the parse: column)."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [parse(document) for document in part]
            yield pd.DataFrame(
                {name: [row.get(key) for row in rows] for key, name in keys.items()}, dtype=object
            )

    fields = ", ".join(f"{name} string" for name in keys.values())
    # Not deterministic, so that no filter repeats the parse.
    survey = F.pandas_udf(run, fields).asNondeterministic()
    return df.select("*", survey(F.col(xml)).alias("_survey")).select(
        *df.columns, *[F.col("_survey")[name].alias(name) for name in keys.values()]
    )


def with_individual_survey(df: DataFrame, xml: str) -> DataFrame:
    """Add the twelve text columns of an individual survey.

    A missing element is null, an empty one is the empty text.  Names and namespace must be
    exact.  Text that is not well-formed gives nulls only.  Of a repeated element
    the first counts, and of an element with inner ones the text before them.
    """
    return _parsed(df, xml, _children, INDIVIDUAL_FIELDS)


def with_store_survey(df: DataFrame, xml: str) -> DataFrame:
    """Add the fields of a store survey; malformed text gives nulls only.

    Names are compared by their ending, in any case, at any depth.
    """
    names = list(dict.fromkeys(STORE_FIELDS.values()))
    numbers = {"yearopened": "int", "numberemployees": "int"}

    def shown(name: str):
        text = F.col(name)
        if name in ("annualrevenue", "annualsales"):
            return money(text).alias(name)
        return text.try_cast(numbers[name]).alias(name) if name in numbers else text

    texts = _parsed(df, xml, _endings, {name: name for name in names})
    return texts.select(*df.columns, *[shown(name) for name in names])
