"""Features, buckets and the draw, against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kontor.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def expected(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    every_s, every_t = s.total(), t.total()

    def gain(b):
        return math.floor(1000 * math.log(
            (t[b] + 1.0) * (every_s + 10000.0) / ((s[b] + 1.0) * (every_t + 10000.0))))

    found = []
    for key, text in rows:
        words, own = features(text)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'null' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((key, len(own), weight, score, len(words)))
    enough = sorted((row for row in found if row[4] >= 20), key=lambda row: (-row[3], row[0] is None, row[0]))
    return found, [row[:4] for row in enough[:25 * len(enough) // 100]]


def compare(docs, target, rows, texts):
    found = resampling.resampled(docs, target).collect()
    wanted, drawn = expected(rows, texts)
    order = {"key": lambda row: (row[0] is not None, row)}
    assert sorted((tuple(r)[:4] for r in found), **order) == sorted((r[:4] for r in wanted), **order)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in ranked] == drawn
    return drawn


def test_given_documents(spark, documents):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert compare(documents, target, rows, [r["text"] for r in target.collect()])


@pytest.mark.parametrize("head, together", [(1 << 15, 4 << 20), (3, 500), (0, 60)])
def test_odd_rows(spark, odd, nothing, monkeypatch, head, together):
    """With a head of all words, of a few, of none; long texts in many segments."""
    monkeypatch.setattr(resampling, "TOGETHER", together)
    monkeypatch.setattr(resampling.frequent, "__defaults__", (head,))
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    target = spark.createDataFrame([("Words of Öl and öl",), (None,)], "text string")
    compare(odd, target, rows, ["Words of Öl and öl", None])
    compare(odd, target.limit(0), rows, [])
    assert resampling.resampled(nothing, target).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé0 .\x00ß\t漢x", max_size=40), min_size=1, max_size=6),
       st.integers(1, 30), st.booleans())
def test_any_text_in_any_segments(texts, together, known):
    head = resampling.Head([b"a", "é".encode(), b"zz"], [(b"a", b"a"), (b"zz", b"a")] if known else [])
    before = resampling.TOGETHER
    resampling.TOGETHER = together
    try:
        found = [Counter() for _ in texts]
        for first, _, again, data, ends in resampling.taken_apart(pa.array(texts)):
            words = resampling.Words(data, ends)
            crcs, pairs = words.crcs(head)
            for of, crc in list(zip(words.of, crcs))[int(again):]:
                found[first + of][int(crc) % 10000] += 1
            for of, crc in zip(words.of[words.first], pairs):
                found[first + of][int(crc)] += 1
    finally:
        resampling.TOGETHER = before
    assert found == [Counter(map(bucket, features(text)[1])) for text in texts]


def test_crc_of_slices():
    data = np.frombuffer(bytes(range(256)) * 3, dtype=np.uint8)
    starts, sizes = np.array([0, 5, 7, 100, 300]), np.array([0, 1, 64, 65, 400])
    states = np.array([0, 9, 1 << 31, 77, 5], dtype=np.uint32)
    wanted = [zlib.crc32(data[s:s + n].tobytes(), int(c)) for s, n, c in zip(starts, sizes, states)]
    assert resampling.crc_states(data, starts, sizes, states).tolist() == wanted
