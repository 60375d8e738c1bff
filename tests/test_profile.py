"""Profiles: exact figures, and estimates within their bounds."""

import math

from pyspark.sql import functions as F

from kontor.operators import profile


def by_column(df):
    return {row.column_name: row for row in df.collect()}


def test_figures_of_a_frame(frame):
    rows = [(1, 2.5, "b", True), (None, float("nan"), None, None), (3, -1.0, "a", False), (3, None, "c", None)]
    found = by_column(profile.profile(profile.sketches(frame(rows, "i INT, d DOUBLE, s STRING, b BOOLEAN"))))
    assert {name: (r.rows, r.nulls, r.distinct) for name, r in found.items()} == {
        "i": (4, 1, 2), "d": (4, 2, 2), "s": (4, 1, 3), "b": (4, 2, 2)}
    assert (found["i"].least, found["i"].largest, found["d"].least) == (1.0, 3.0, -1.0)
    assert (found["s"].first, found["s"].last, found["b"].first) == ("a", "c", "false")


def test_nothing_and_nulls_only(frame):
    for rows in ([], [(None, None)] * 3):
        found = by_column(profile.profile(profile.sketches(frame(rows, "i INT, s STRING"))))
        assert all((r.rows, r.nulls, r.distinct) == (len(rows), len(rows), 0) for r in found.values())
        assert all(r.least is None and r.first is None and r.quartiles is None for r in found.values())


def test_estimates_and_merging(spark):
    """Distinct values within four standard deviations, quartiles within two percent of rank."""
    df = spark.range(200_000).select(
        "id", (F.col("id") % 5000).alias("few"), F.concat(F.lit("x"), (F.col("id") % 70_000)).alias("text"),
        F.when(F.col("id") % 3 == 0, F.sqrt("id")).alias("root"))
    whole = by_column(profile.profile(profile.sketches(df)))
    parts = [profile.sketches(df.filter(f"id % 4 = {n}")) for n in range(4)]
    parts.append(profile.sketches(df.limit(0)))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    joined = by_column(profile.profile(profile.merged(union)))
    bound = 4 * 1.04 / math.sqrt(1 << profile.LG_BUCKETS)
    for found in (whole, joined):
        for name, true in (("id", 200_000), ("few", 5000), ("text", 70_000), ("root", 66_667)):
            assert abs(found[name].distinct - true) <= bound * true
        for share, got in zip((0.25, 0.5, 0.75), found["id"].quartiles):
            assert abs(got / 200_000 - share) < 0.02
        assert found["root"].nulls == 133_333 and found["id"].largest == 199_999


def test_one_pass(frame):
    text = profile.sketches(frame([(1, "a")], "i INT, s STRING"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Expand" not in text
