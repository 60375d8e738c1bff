"""Operators on their edge cases."""

import datetime as dt
from collections import Counter

import pytest
from helpers import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kontor.operators import columns, hierarchy, integrity, loading, reporting
from kontor.operators.dedupe import first_per_key, latest_per_key
from kontor.operators.lookup import PLACE, lookup_composite, lookup_key, translate


def test_lookup_key(frame):
    rows = frame([(1, "a"), (2, "b"), (3, None), (4, "d")], "i INT, code STRING")
    dimension = frame(
        [("a", 10, "x"), (None, 20, "x"), ("d", 30, "x"), ("d", 31, "x")], "alt STRING, key INT, other STRING"
    )
    assert values(lookup_key(rows, dimension, "code", "alt", "key"), "i", "key") == [
        (1, 10), (2, None), (3, 20), (4, 30), (4, 31)]
    assert values(lookup_key(rows, dimension, "code", "alt", "key", null_safe=False), "i", "key")[2] == (3, None)
    assert values(lookup_key(rows, None, "code", "alt", "key"), "i", "key") == [
        (1, None), (2, None), (3, None), (4, None)]


def test_lookup_key_replaces_a_column_of_that_name(frame):
    rows = frame([("AW1",)], "key STRING")
    dimension = frame([("AW1", 5)], "alt STRING, key INT")
    assert lookup_key(rows, dimension, "key", "alt", "key").collect() == [(5,)]


def test_lookup_composite(frame):
    rows = frame([(1, " Seattle ", "98104 "), (2, "X", "1"), (3, None, "9")], "i INT, city STRING, postalcode STRING")
    geography = frame(
        [(7, "seattle", "98104"), (5, "SEATTLE", " 98104"), (9, None, "9")],
        "geographykey INT, city STRING, postalcode STRING",
    )
    found = lookup_composite(rows, geography, PLACE, "geographykey")
    assert values(found, "i", "geographykey") == [(1, 5), (2, None), (3, 9)]
    assert lookup_composite(rows, None, PLACE, "geographykey").filter("geographykey IS NULL").count() == 3


def test_translate(frame):
    rows = frame([("red",), ("odd",), (None,)], "word STRING")
    dictionary = frame(
        [("red", "es", "rojo"), ("red", "es", "zzz"), ("odd", "fr", "impair")],
        "text STRING, lang STRING, translated STRING",
    )
    assert values(translate(rows, "word", {"es": "es"}, dictionary)) == [
        (None, None), ("odd", "odd"), ("red", "rojo")]
    assert values(translate(rows, "word", {"es": "es"}, None))[1] == ("odd", "odd")


def test_first_and_latest_per_key(frame):
    rows = frame([(1, "b", 1), (1, "a", 2), (1, None, 3), (None, "x", 1), (None, "w", 2)], "k INT, v STRING, n INT")
    assert values(first_per_key(rows, ["k"]), "k", "v") == [(None, "w"), (1, "a")]
    assert values(latest_per_key(rows, ["k"], "n"), "k", "v") == [(None, "w"), (1, None)]


def test_insert_only_new(frame):
    layout = "a INT, b STRING, v INT"
    batch = frame([(1, "x", 1), (2, None, 2), (3, "n", 3), (3, "n", 4), (None, None, 5)], layout)
    existing = frame([(1, "x", 9), (2, None, 9), (None, None, 9), (None, None, 8)], layout)
    new = loading.insert_only_new(batch, existing, ["a", "b"])
    assert new.columns == batch.columns
    assert values(new) == [(3, "n", 3), (3, "n", 4)]
    assert loading.insert_only_new(batch, existing.limit(0), ["a", "b"]).count() == 5
    assert loading.insert_only_new(batch.limit(0), existing, ["a", "b"]).count() == 0
    assert loading.insert_only_new(batch, None, ["a", "b"]).count() == 5


_KEYS = st.lists(
    st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "", "x"])), max_size=12
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(_KEYS, _KEYS)
def test_insert_only_new_of_any_keys(frame, incoming, present):
    layout = "a INT, b STRING"
    found = loading.insert_only_new(frame(incoming, layout), frame(present, layout), ["a", "b"])
    assert Counter(map(tuple, found.collect())) == Counter(key for key in incoming if key not in present)


def test_insert_only_new_across_number_types(frame):
    batch, existing = frame([(1,), (2,)], "k INT"), frame([(2,)], "k BIGINT")
    assert values(loading.insert_only_new(batch, existing, ["k"])) == [(1,)]


@pytest.mark.parametrize("latest, expected", [("2020-01-02", True), ("2020-01-01", False), ("2019-12-31", False)])
def test_load_gate(frame, latest, expected):
    target = frame([(dt.date(2020, 1, 1), dt.datetime.fromisoformat(latest + " 23:00:00"))], "saved DATE, orderdate TIMESTAMP_NTZ")
    assert loading.has_new_fact_data(target) is expected


def test_load_gate_without_data_or_columns(frame):
    target = frame([], "saved DATE, date TIMESTAMP_NTZ")
    assert loading.has_new_fact_data(target, date="date")
    assert loading.has_new_fact_data(None)
    assert not loading.has_new_fact_data(target, saved="nowhere", date="date")
    assert loading.needs_first_load(target) and loading.needs_first_load(None)


def test_source_is_newer(frame):
    older, newer = frame([(1,)], "d INT"), frame([(2,)], "d INT")
    assert loading.source_is_newer(newer, older, "d")
    assert not loading.source_is_newer(older, newer, "d")
    assert not loading.source_is_newer(older, older, "d")
    assert loading.source_is_newer(older, older.limit(0), "d")
    assert not loading.source_is_newer(older.limit(0), older, "d")


def test_stamp(frame):
    rows = frame([(1,)], "i INT")
    assert loading.stamp(rows, dt.date(2026, 1, 1)).first().saved == dt.date(2026, 1, 1)
    assert loading.stamp(rows).first().saved is not None


def test_integrity(frame):
    fact = frame([(1, 5), (2, 5), (3, 6), (4, None), (4, 7)], "pk INT, fk INT")
    dimension = frame([(5,), (6,)], "k INT")
    assert values(integrity.pk_violations(fact, ["pk"])) == [(4, 2)]
    assert values(integrity.null_violations(fact, ["pk", "fk"])) == [("fk", 1)]
    assert values(integrity.fk_orphans(fact, "fk", dimension, "k")) == [(7, 1)]


def test_with_root(frame):
    groups = frame([("b",), ("a",)], "name STRING")
    tree = hierarchy.with_root(groups, "name", "Corporate", "key", "parent")
    assert values(tree, "key", "name", "parent") == [(1, "Corporate", None), (2, "a", 1), (3, "b", 1)]


def test_division_tree(frame):
    territories = frame([("West", "C1"), ("East", "C2")], "name STRING, country STRING")
    tree = hierarchy.division_tree(territories, "name", "key", "parent")
    assert values(tree, "key", "parent", "name", "country", "is_division") == [
        (1, None, "East Division", "C2", True), (2, None, "West Division", "C1", True),
        (3, 1, "East", "C2", False), (4, 2, "West", "C1", False)]


def test_parent_key(frame):
    rows = frame([("1000", None, 1), ("1010", "1000", 2), ("9", "8", 3)], "code STRING, parent STRING, key INT")
    found = hierarchy.parent_key(rows, "parent", "code", "key", "parentkey")
    assert values(found, "key", "parentkey") == [(1, None), (2, 1), (3, None)]


def test_pivot(frame):
    rows = frame([(1, "a", 2.0), (1, "b", 3.0), (2, "a", 4.0)], "i INT, c STRING, v DOUBLE")
    wide = reporting.pivot_report(rows, ["i"], "c", "v", ["a", "b"])
    assert [tuple(row) for row in wide.collect()] == [(1, 2.0, 3.0), (2, 4.0, None)]
    filled = reporting.pivot_report(rows, ["i"], "c", "v", fill=0)
    assert [tuple(row) for row in filled.collect()] == [(1, 2.0, 3.0), (2, 4.0, 0.0)]
    twice = rows.unionByName(frame([(1, "a", 4.0)], "i INT, c STRING, v DOUBLE"))
    assert reporting.pivot_report(twice, ["i"], "c", "v").first().a == 3.0


def test_top_n_and_share(frame):
    rows = frame([("b", 2.0), ("a", 2.0), ("c", 1.0), ("d", None)], "n STRING, v DOUBLE")
    assert [row.n for row in reporting.top_n(rows, "v", 2, ["n"]).collect()] == ["a", "b"]
    shares = {row.n: row.share for row in reporting.share_of_total(rows, "v").collect()}
    assert shares == {"a": 40.0, "b": 40.0, "c": 20.0, "d": None}
    nothing = reporting.share_of_total(frame([("a", 0.0)], "n STRING, v DOUBLE"), "v")
    assert nothing.first().share is None


def test_conform(frame):
    rows = frame([("5", 1)], "B STRING, a INT")
    shaped = columns.conform(rows, "a BIGINT, b INT, c DATE")
    assert shaped.columns == ["a", "b", "c"] and tuple(shaped.first()) == (1, 5, None)


def test_column_choice(frame):
    rows = frame([(1, 2)], "ResellerKey INT, other INT")
    assert columns.choose_column(rows, ["PRODUCTKEY", "resellerkey"]) == "ResellerKey"
    assert columns.choose_column(rows, ["nothing"]) == "ResellerKey"
    assert columns.find_column(rows, "nothing") is None
    assert rows.select(columns.find_column(rows, "OTHER")).first()[0] == 2


def test_nan_to_null(frame):
    rows = frame([(1, float("nan")), (2, 1.5), (3, None)], "i INT, x DOUBLE")
    assert values(columns.nan_to_null(rows)) == [(1, None), (2, 1.5), (3, None)]


def test_computed_once(frame):
    rows = frame([(1,), (2,)], "i INT")
    found = columns.computed_once(rows, (F.col("i") * 2).alias("twice"), F.lit(None).cast("int").alias("n"))
    assert values(found) == [(1, 2, None), (2, 4, None)]


def test_insert_only_new_compares_in_the_wider_type(frame):
    batch = frame([(1, "a"), (2, "b")], "k INT, v STRING")
    existing = frame([(5_000_000_000, "x"), (2, "y")], "k BIGINT, v STRING")
    assert values(loading.insert_only_new(batch, existing, ["k"])) == [(1, "a")]
    assert values(loading.insert_only_new(existing, batch, ["k"])) == [(5_000_000_000, "x")]


def test_a_load_without_news_writes_no_file(spark, frame, tmp_path):
    from kontor.plans.warehouse import Warehouse
    warehouse = Warehouse(spark, str(tmp_path))
    rows = frame([(1, "a"), (2, "b")], "k INT, v STRING")
    warehouse.load("rows", rows, ["k"])
    files = sorted(tmp_path.glob("rows/*.parquet"))
    for _ in range(3):
        assert warehouse.load("rows", rows, ["k"]) == 0
        assert warehouse["rows"].count() == 2 and sorted(tmp_path.glob("rows/*.parquet")) == files
    assert warehouse.load("rows", frame([(3, "c")], "k INT, v STRING"), ["k"]) == 1


def test_a_load_leaves_no_intermediate_results(spark, frame, tmp_path):
    from pathlib import Path

    from kontor.plans.warehouse import Warehouse
    from kontor.session import application_folder
    folder = Path(application_folder(spark))
    before = set(folder.glob("*"))
    warehouse = Warehouse(spark, str(tmp_path))
    batch = frame([("USD", "dollar"), ("EUR", "euro")], "currencyalternatekey STRING, currencyname STRING")
    assert [warehouse.load("dimcurrency", batch) for _ in range(2)] == [2, 0]
    assert set(folder.glob("*")) == before
