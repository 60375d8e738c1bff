"""Whole texts reach Python workers in batches of bounded bytes."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kontor.llm import common, lang_id, packing, queries, simhash

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
ROWS, CHARS = 3000, 4000


@pytest.fixture
def texts(spark):
    """12 MB of texts in one partition, and a session without a limit of its own."""
    before = spark.conf.getAll.get(KEY)
    spark.conf.unset(KEY)
    yield spark.range(0, ROWS, 1, 1).select(
        F.col("id").alias("doc_id"), F.rpad(F.col("id").cast("string"), CHARS, " word").alias("text"),
        F.lit("en").alias("lang"),
    )
    if before is None:
        spark.conf.unset(KEY)
    else:
        spark.conf.set(KEY, before)


def sizes(docs):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"]
            )

    return docs.select("text").mapInArrow(run, "rows bigint, bytes bigint").collect()


@pytest.mark.parametrize("operator", [
    lang_id.keep_identified,
    simhash.fingerprints,
    lambda docs: packing.encoded(docs, queries.tokenizer_path(), "text", "doc_id"),
], ids=["language_id", "near_dedup", "packing"])
def test_a_worker_gets_few_bytes_at_once(texts, operator):
    found = operator(texts)
    got = sizes(texts)
    assert sum(row["rows"] for row in got) == ROWS
    assert max(row["bytes"] for row in got) <= (4 << 20) + 2 * CHARS
    assert found.count() == ROWS


def test_a_limit_that_is_given_stays(spark, texts):
    spark.conf.set(KEY, "1m")
    assert common.in_small_batches(texts) is texts
    assert spark.conf.get(KEY) == "1m"
    assert max(row["bytes"] for row in sizes(texts)) <= (1 << 20) + 2 * CHARS
