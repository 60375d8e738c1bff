"""Reading and writing."""

import pytest
from helpers import SMALL, values

from kontor import session
from kontor.sources import tables
from kontor.streaming.incremental import load_stream
from kontor.plans.warehouse import Warehouse


def test_load_tables(spark):
    found = tables.load_tables(spark, ["nation", "region"], SMALL)
    assert found["nation"].count() == 25 and list(found) == ["nation", "region"]


def test_load_tables_from_the_catalog(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert tables.load_tables(spark, ["three"])["three"].count() == 3


def test_append_counts_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.append(spark.range(5), path) == 5
    assert tables.append(spark.range(2), path) == 2
    assert spark.read.parquet(path).count() == 7


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.replace_table(spark.range(5), path) == 5
    assert tables.replace_table(spark.range(2), path) == 2
    assert tables.replace_table(spark.range(0), path) == 0
    assert tables.replace_table(spark.range(9), path, probe=spark.range(0)) == 0
    assert tables.read_table(spark, path).count() == 2


def test_csv_keeps_separators_quotes_and_letters(spark, tmp_path):
    rows = spark.createDataFrame([("a;b", 1), ('say "x"', 2), ("año", 3)], "t STRING, i INT")
    path = tables.export_csv(rows, "out", str(tmp_path), sep=";")
    assert path.endswith("out.csv")
    assert tables.export_csv(rows, "out.csv", str(tmp_path), sep=";") == path
    back = spark.read.csv(path, header=True, sep=";", schema="t STRING, i INT", escape='"')
    assert values(back, "i", "t") == [(1, "a;b"), (2, 'say "x"'), (3, "año")]


def test_stored_results_are_read_back_and_discarded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    kept = session.stored(spark.range(5))
    assert kept.count() == 5 and len(list(tmp_path.iterdir())) == 1
    session.discard_stored(spark)
    assert not list(tmp_path.iterdir())


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or session.shared_folder(spark) == named.rstrip("/")


def test_jdbc_options():
    whole = tables.jdbc_read_options("jdbc:x", "sales.orders", properties={"user": "u"})
    assert whole == {"user": "u", "url": "jdbc:x", "dbtable": "sales.orders"}
    split = tables.jdbc_read_options("jdbc:x", "t", column="id", bounds=(0, 100), partitions=8)
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "8")
    with pytest.raises(TypeError):
        tables.jdbc_read_options("jdbc:x", "t", column="id")


def test_stream_loads_new_rows_once(spark, tmp_path):
    landing, warehouse = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "dw"))
    spark.range(5).write.parquet(landing)
    warehouse.load("ids", spark.range(2), ["id"])

    def run():
        stream = spark.readStream.schema("id BIGINT").parquet(landing)
        load_stream(stream, warehouse, "ids", str(tmp_path / "offsets"), ["id"]).awaitTermination()

    run()
    assert values(warehouse["ids"]) == [(n,) for n in range(5)]
    spark.range(3, 8).write.mode("append").parquet(landing)
    run()
    run()
    assert values(warehouse["ids"]) == [(n,) for n in range(8)]
