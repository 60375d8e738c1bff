"""Elias-Fano sequences, files of ids, and the query against one pass in plain Python."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from tokenizers import Tokenizer

from kontor.llm import queries, token_files


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.mark.parametrize("values", [
    [], [0], [7], [0, 0, 0], list(range(2000)), [n * n for n in range(3000)], [0, 1 << 62],
    [0] * 700 + [5] * 700, [0, (1 << 64) - 1],
])
def test_elias_fano(values):
    values = np.array(values, dtype=np.uint64)
    found = token_files.EliasFano(*token_files.EliasFano.encode(values))
    for first in range(0, len(values), 97):
        for last in (first, first + 1, len(values)):
            assert found.select(first, last).tolist() == values[first:last].tolist()


def test_few_bits_for_each_boundary():
    rng = np.random.default_rng(3)
    starts = np.cumsum(rng.integers(1, 1000, 20_000)).astype(np.uint64)
    low, parts = token_files.EliasFano.encode(starts)
    bits = 8 * sum(map(len, parts)) / len(starts)
    assert bits <= 2.5 + np.log2(500) < 64


def expected(rows, tokenizer):
    """By one document after the other."""
    start, found = 0, []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        found.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return found


def test_given_documents(spark, documents, tokenizer):
    rows = sorted((row["doc_id"], row["text"]) for row in documents.collect())
    found = queries.QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, found)) == expected(rows, tokenizer)


def test_odd_rows(spark, odd, nothing, tokenizer):
    found = token_files.through_files(odd, queries.tokenizer_path()).collect()
    rows = [(row["doc_id"], row["text"]) for row in odd.select("doc_id", "text").collect()]
    ids = {}
    for key, text in rows:
        ids.setdefault(key, []).append(expected([(key, text)], tokenizer)[0][2:])
    got = {}
    for row in found:
        got.setdefault(row["doc_id"], []).append((row["n_tokens"], row["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ids.items()}
    order = sorted(found, key=lambda row: row["start"])
    assert [row["start"] for row in order] == (
        np.cumsum([0] + [row["n_tokens"] for row in order[:-1]]).tolist()
    )
    keys = [row["doc_id"] for row in order]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert token_files.through_files(nothing, queries.tokenizer_path()).count() == 0


def test_an_id_of_most_rows_fills_many_files(spark, tokenizer, tmp_path):
    rows = [(5, f"text {n % 40}") for n in range(600)] + [(n, "a few words") for n in range(-20, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    files = token_files.write(docs, queries.tokenizer_path(), f"{tmp_path}/ids")
    held = {row["part"]: row for row in files.collect()}
    assert len(held) > 4 and max(row["documents"] for row in held.values()) < 400
    found = sorted(map(tuple, token_files.read(files).collect()), key=lambda row: row[1])
    assert [row[0] for row in found] == sorted(key for key, _ in rows)
    wanted = sorted(row[0::2] for row in expected(rows, tokenizer))
    assert sorted((row[0], row[2]) for row in found) == wanted
    # Any document from a file, by its number.
    path = held[min(held)]["path"]
    with pafs.LocalFileSystem().open_input_file(path) as file:
        opened = token_files.TokenFile(file)
        assert opened.doc_ids(0, 3) == [-20, -19, -18]
        ids = tokenizer.encode("a few words", add_special_tokens=False).ids + [1]
        assert opened[2].tolist() == ids and len(opened) == held[min(held)]["documents"]


def test_a_document_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 100)
    sink = pa.BufferOutputStream()

    class Kept:
        write, close = sink.write, staticmethod(lambda: None)

    writer = token_files.TokenWriter(Kept, 2)
    sizes = np.array([3, 1000, 40, 50, 60, 1])
    ids = np.arange(sizes.sum(), dtype="<u2")
    writer.add(np.array([1, 2, 2, 3, 9, 10]), 0, sizes, ids.tobytes())
    writer.close()
    opened = token_files.TokenFile(pa.BufferReader(sink.getvalue()))
    ends = np.cumsum(sizes)
    checks = [zlib.crc32(ids[e - s:e].astype("<u4").tobytes()) for s, e in zip(sizes, ends)]
    for rows in (2, 1024):
        found = list(opened.digests(rows))
        assert [x for part in found for x in part[3]] == checks
        assert [x for part in found for x in part[0]] == [1, 2, 2, 3, 9, 10]
