"""Surrogate-key lookups and translations.

No lookup forces a broadcast.  Spark broadcasts a dimension whose size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
where adaptive execution splits the rows of a hot key.  Spark takes a join for as large as
the product of its sides; ``broadcast_if_few`` counts instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.functions.text import normalized, strip
from kontor.operators.dedupe import first_per_key


# Rows of a narrow table that are broadcast: some tens of megabytes.
FEW = 1 << 18


def broadcast_if_few(df: DataFrame, limit: int = FEW) -> DataFrame:
    """The frame, marked for broadcast if it is counted to have at most ``limit`` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def lookup_key(
    rows: DataFrame,
    dimension: DataFrame | None,
    business_key: str,
    alternate_key: str,
    surrogate_key: str,
    null_safe: bool = True,
) -> DataFrame:
    """Add ``surrogate_key`` of the dimension row whose alternate key matches.

    Rows without a match get null, as do all rows when the dimension is
    missing.  Null keys match each other; a key the dimension holds twice
    gives two rows.  A column of ``rows`` already called ``surrogate_key`` is
    replaced.
    """
    kept = [name for name in rows.columns if name.lower() != surrogate_key.lower()]
    if dimension is None:
        return rows.select(*kept, F.lit(None).cast("int").alias(surrogate_key))
    found = dimension.select(
        F.col(alternate_key).alias("_alternate"), F.col(surrogate_key).alias("_found")
    )
    left, right = rows[business_key], found["_alternate"]
    condition = left.eqNullSafe(right) if null_safe else left == right
    return rows.join(found, condition, "left").select(
        *[rows[name] for name in kept], F.col("_found").alias(surrogate_key)
    )


def lookup_composite(
    rows: DataFrame,
    dimension: DataFrame | None,
    forms: Mapping[str, Callable[[Column], Column]],
    surrogate_key: str,
) -> DataFrame:
    """Lookup on several columns, each compared in a normalized form.

    The dimension is first reduced to one row (the lowest key) per normalized
    combination, so that no row multiplies.
    """
    if dimension is None:
        return rows.withColumn(surrogate_key, F.lit(None).cast("int"))
    normal = [form(F.col(name)).alias(f"_{name}") for name, form in forms.items()]
    found = first_per_key(
        dimension.select(*normal, F.col(surrogate_key).alias("_found")),
        [f"_{name}" for name in forms],
        ["_found"],
    )
    condition = None
    for name, form in forms.items():
        part = form(rows[name]).eqNullSafe(found[f"_{name}"])
        condition = part if condition is None else condition & part
    kept = [name for name in rows.columns if name.lower() != surrogate_key.lower()]
    return rows.join(found, condition, "left").select(
        *[rows[name] for name in kept], F.col("_found").alias(surrogate_key)
    )


# City names are compared trimmed and in lower case, postal codes trimmed only.
PLACE = {"city": normalized, "postalcode": strip}


def translate(
    df: DataFrame, source: str, targets: Mapping[str, str], dictionary: DataFrame | None
) -> DataFrame:
    """Add translations of ``source``, a column per language (``language: column``);
    untranslated text stays.

    ``dictionary`` has the columns text, lang and translated.  It is read and grouped once
    for all languages.  Without one, the new columns are copies.
    """
    if dictionary is None:
        return df.withColumns({target: F.col(source) for target in targets.values()})
    entries = dictionary.filter(F.col("lang").isin(*targets)).groupBy(
        F.col("text").alias("_text")
    ).agg(*[
        F.min(F.when(F.col("lang") == language, F.col("translated"))).alias(f"_{language}")
        for language in targets
    ])
    return df.join(entries, df[source] == entries["_text"], "left").select(
        *[df[name] for name in df.columns],
        *[
            F.coalesce(F.col(f"_{language}"), df[source]).alias(target)
            for language, target in targets.items()
        ],
    )
