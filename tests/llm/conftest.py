import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

LAYOUT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "Words of a very long text, again and again é 12 . " * 4000
ODD = [
    (1, "the same text, twice", "en", "a", 20), (2, "the same text, twice", "fr", None, 20),
    (3, None, "en", "a", 0), (4, "", None, "b", None), (5, " \t\n", "en", "b", 3),
    (6, LONG, "en", "a", len(LONG)), (7, "one", None, "c", 3), (7, "one", None, "c", 3),
    (8, "12 34 !?", "en", None, 8), (None, "no id at all", "en", "d", 12),
    (None, "no id at all", "en", "d", 12), (9, "the same text, twice", "en", "a", 20),
    (10, "Das ist ein kurzer Text über nichts", "de", "é", 30),
    (11, "\U0001f600 smile x@y.example.org \U0001f600 +1 (234) 555-6789", "en", "z", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like inner ones."""
    docs = spark.createDataFrame(ODD, LAYOUT)
    for name in ("_digest", "_mark", "_copies", "_text", "_found", "score", "spans", "a.b", "place"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], LAYOUT)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {row["doc_id"]: row["text"] for row in documents.collect()}
