"""Profiles of tables: what each column holds, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accuracy of the sketches: 2^LG_BUCKETS buckets for distinct values (an error of 1.6 % at
# one standard deviation), K items for quantiles (1.7 % of rank, both sides).
LG_BUCKETS = 12
K = 200

_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _measures(name: str, kind: T.DataType) -> Column:
    """What is kept of one column; all of it can be merged."""
    column = F.col("`" + name.replace("`", "``") + "`")
    number = isinstance(kind, T.NumericType)
    real = column.cast("double")
    # Not a number counts as null, as everywhere in this library.
    known = F.when(~F.isnan(real), column) if isinstance(kind, (T.DoubleType, T.FloatType)) else column
    ordered = isinstance(kind, _ORDERED)
    hashed = F.when(known.isNotNull(), F.xxhash64(known))
    return F.struct(
        F.lit(name).alias("column_name"),
        F.lit(kind.simpleString()).alias("column_type"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(known.isNull()).alias("nulls"),
        (F.min(known.cast("double")) + F.lit(0.0) if number else F.lit(None).cast("double")).alias("least"),
        (F.max(known.cast("double")) + F.lit(0.0) if number else F.lit(None).cast("double")).alias("largest"),
        (F.min(known).cast("string") if ordered and not number else F.lit(None).cast("string")).alias("first"),
        (F.max(known).cast("string") if ordered and not number else F.lit(None).cast("string")).alias("last"),
        (F.lit(None).cast("binary") if isinstance(kind, (T.MapType, T.VariantType))
         else F.hll_sketch_agg(hashed, F.lit(LG_BUCKETS))).alias("distinct_sketch"),
        (F.kll_sketch_agg_double(known.cast("double"), K) if number
         else F.lit(None).cast("binary")).alias("quantile_sketch"),
    )


def sketches(df: DataFrame) -> DataFrame:
    """One row per column with counts, extremes and sketches; one pass, a row per task is sent."""
    measures = [_measures(field.name, field.dataType) for field in df.schema]
    return df.agg(F.array(*measures).alias("columns")).select(F.inline("columns"))


def merged(parts: DataFrame) -> DataFrame:
    """Sketches of parts of a table, such as its loads, as those of the whole."""
    return parts.groupBy("column_name", "column_type").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("least").alias("least"), F.max("largest").alias("largest"),
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def profile(of: DataFrame) -> DataFrame:
    """Sketches as figures: rows, nulls, about how many distinct values, extremes, quartiles."""
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    known = F.col("rows") > F.col("nulls")
    return of.select(
        "column_name", "column_type", "rows", "nulls",
        F.when(known, F.hll_sketch_estimate("distinct_sketch")).otherwise(0).alias("distinct"),
        "least", "largest", "first", "last",
        F.when(F.col("least").isNotNull(),
               F.kll_sketch_get_quantile_double("quantile_sketch", shares)).alias("quartiles"),
    )
