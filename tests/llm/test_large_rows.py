"""Rows that are large in their own way: many matches, many labels, many copies of a query."""

import time

import numpy as np
from pyspark.sql import functions as F

from kontor.llm import knn, pii, queries, url_filter


def test_many_addresses_in_one_text(spark):
    count = 100_000
    text = " ".join(f"a{n}@b{n % 7}.org" for n in range(count))
    docs = spark.createDataFrame([(1, text), (2, "x@y.org")], "doc_id bigint, text string")
    begun = time.time()
    found = {row["doc_id"]: row for row in pii.pii(docs).collect()}
    assert time.time() - begun < 60
    assert found[1]["n_email"] == count and found[2]["n_email"] == 1
    at, spans = 0, []
    for word in text.split(" "):
        spans.append(f"email:{at}:{at + len(word)}")
        at += len(word) + 1
    assert found[1]["spans"] == ",".join(spans)


def test_many_accounts_in_one_text(spark):
    one = "DE89370400440532013000"
    docs = spark.createDataFrame([(1, f"iban {one} " * 3000)], "doc_id bigint, text string")
    row = pii.pii(docs).first()
    assert row["spans"].count("iban:") == 3000


def test_context_words_are_whole_words(spark):
    texts = ["The syntax 123-45-6789", "taxi 123-45-6789", "tax 123-45-6789", "Taxes: 123-45-6789",
             "my SSNs 123-45-6789, 987-65-4321", "ssn" + " " * 44 + "123-45-6789", "xssn" + " " * 45 + "123-45-6789",
             "ssn" + " " * 60 + "123-45-6789"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {row["doc_id"]: row["spans"].count("ssn:") for row in pii.pii(docs).collect()}
    assert [found[n] for n in range(len(texts))] == [0, 0, 1, 0, 2, 1, 0, 0]


def test_many_labels_in_one_host(spark):
    urls = ["http://" + "a." * 50_000 + "net/x", "http://" + "a." * 50_000 + "example.net/en/y", "http://org/fr/",
            "http://" + "." * 50_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    begun = time.time()
    found = {row["page_id"]: row["rule"] for row in url_filter.judged(pages, rules).collect()}
    assert found == {0: "net/", 1: "example.net/en/", 2: "org/fr/", 3: None}
    assert time.time() - begun < 30
    joined = {row["page_id"]: row["rule"] for row in url_filter.by_join(pages, rules, [1, 4], labels=2).collect()}
    assert joined == found


def test_a_query_that_repeats(spark):
    draw = np.random.default_rng(8)
    for copies in (30, 3000):
        rows = [(0, [2.0, 1.0, 0.0])] * copies + [(0, [0.1, 0.0, 0.3])] * 25
        rows += [(n, draw.normal(size=3).tolist()) for n in range(1, 300)] + [(40, [1.0, 1.0, 1.0])] * 30
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        got = knn.top_k(table, queries.every("id", 20), slice_rows=64)
        asked = sorted({(tuple(np.floor(64 * np.array(v))), k) for k, v in rows if k == 0})
        data = [(k, np.floor(64 * np.array(v))) for k, v in rows if k != 0]
        best = sorted((-int(max(np.dot(q, x) for q in [np.array(asked[0][0])])), k) for k, x in data)[:20]
        found = {}
        for row in got.filter("query_id = 0").orderBy("rank").collect():
            found.setdefault(row["rank"], []).append((-row["score"], row["vec_id"]))
        assert sorted(found) == list(range(1, 21)), copies
        own = got.filter("query_id = 40").agg(F.count("*")).first()[0]
        assert own == 20 and len(best) == 20
