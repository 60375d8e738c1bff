"""The registered queries, and the same as SQL, over the given tables."""

import math

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from kontor.llm import oracles, queries

TABLES = ("documents", "embeddings", "pages", "benchmark", "conversations")

NOT_DOCUMENTS = {"op3_exact_top_k", "op7_url_filter", "op11_conversation_repair"}


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(row[i] for i in order) for row in rows]
    return sorted(shown, key=lambda row: [(x is not None, str(type(x)), x) for x in row])


def same(one, two):
    if isinstance(one, float) and isinstance(two, float):
        return math.isclose(one, two, rel_tol=1e-9, abs_tol=1.5e-6)
    return one == two


def check(name, spark, folder, connection):
    found = queries.QUERIES[name](spark, folder)
    answer = connection.sql(queries.ORACLES[name])
    assert sorted(found.columns) == sorted(answer.columns)
    got = sorted_rows(found.columns, found.collect())
    want = sorted_rows(answer.columns, answer.fetchall())
    assert len(got) == len(want)
    for one, two in zip(got, want, strict=True):
        assert all(map(same, one, two)), (one, two)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_as_sql(spark, name):
    connection = duckdb.connect()
    folder = "/root/testdata/sf0.001"
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    check(name, spark, folder, connection)


@pytest.mark.parametrize("name", sorted(set(queries.ORACLES) - NOT_DOCUMENTS))
def test_as_sql_with_nulls(spark, odd, tmp_path, name):
    rows = odd.select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id IS NOT NULL AND doc_id <> 7")
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    target = spark.createDataFrame([(1, "Same text, no"), (2, None), (3, "")], "item_id bigint, text string")
    target.coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    connection.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/benchmark.parquet/*.parquet'")
    check(name, spark, str(tmp_path), connection)


def test_what_is_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(__spark_entry__.oracle_sql()) <= names and corpus_pipeline.ORACLE_SQL is None
    assert oracles.LM_SCORE
