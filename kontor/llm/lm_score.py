"""Stupid-backoff scores of documents by n-gram counts of all others.

Every n-gram of words up to ``ORDER`` is counted over the whole corpus.  A document
is scored by the counts without its own share, so text that only it has is backed
off: with ``k`` the longest n-gram that ends at a word inside the document, the word's score is
``BACKOFF^(k-m) * c(m-gram) / c(its first m-1 words)`` for the largest ``m`` whose count
isn't zero, down to ``c(word) / N``, and ``BACKOFF^k / N`` for a word that is nowhere else.
``N`` are the words of the other documents, 1 at least.

How the count tables meet the n-grams: documents are taken in blocks of
some ``BLOCK_BYTES``, and a block's n-grams are counted before they are shuffled.  Their
64-bit hashes, sorted and stored as differences, go to one of as many parts of the hash
range as there are shuffle partitions; each part sums the counts of all blocks and answers
every block with the totals of its n-grams.  The answers meet the block's texts,
and scores are summed per document.  A frequent n-gram costs one entry per
block, a long document or a large group of copies nothing more than its text.

* Words are longest runs of characters other than ASCII white space, A-Z lower-cased.
* A null or empty text has no words, score 0 and mean 0.  Rows that repeat are
  documents of their own, and so are copies, which then see each other.
* An empty table gives an empty result.
* Blocks are cut by the order in which a partition is read, twice: ``docs`` must be read
  from a table, not be the result of a shuffle.  A block that differs raises an error.
* Counts of different n-grams whose hashes agree are added up: of a billion
  n-grams one pair in forty such corpora.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import named, tasks, whole
from kontor.session import stored

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_ROWS = "block bigint, part int, size int, raw binary, counts binary, ids array<bigint>"
_TOGETHER = 512


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


class Grams:
    """The n-grams of some texts: at every word, the hash of each n-gram that ends there."""

    def __init__(self, texts: list[bytes], order: int) -> None:
        # One text at a time: words take many times the room of their hashes.
        hashed = [
            np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
            for words in (text.lower().split() for text in texts)
        ]
        self.lengths = np.fromiter(map(len, hashed), dtype=np.int64, count=len(hashed))
        self.total = int(self.lengths.sum())
        hashes = np.concatenate([np.zeros(0, dtype=np.uint64), *hashed])
        del hashed
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(self.total) - np.repeat(starts, self.lengths)
        self.keys, self.ends = [hashes], [np.arange(self.total)]
        grown = hashes
        for size in range(2, order + 1):
            longer = np.zeros_like(hashes)
            longer[1:] = _mixed(grown[:-1] * _MULTIPLIER + hashes[1:])
            grown = longer
            ends = np.flatnonzero(self.place >= size - 1)
            self.keys.append(grown[ends])
            self.ends.append(ends)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, first bytes together, then second ones, and compressed."""
    raw = values.view(np.uint8).reshape(len(values), -1).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _numbers(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = zstandard.ZstdDecompressor().decompress(raw)
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _packed(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(_numbers(raw, "<u8"), dtype=np.uint64)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        ["block", "part", "size", "raw", "counts", "ids"],
    )


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, list]]:
    """Number, ids and texts of each block of a partition."""
    block = TaskContext.get().partitionId() << 32
    ids, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch["id"].to_pylist(), batch["raw"].to_pylist(), strict=True):
            ids.append(key)
            texts.append(text)
            held += len(text) + 1
            if held >= size:
                yield block, ids, texts
                block, ids, texts, held = block + 1, [], [], 0
    if ids:
        yield block, ids, texts


def _asked(docs: DataFrame, order: int, parts: int, size: int) -> DataFrame:
    """The distinct n-grams of every block with their counts there, by part of the hash range."""
    width = np.uint64(-(-(1 << 64) // parts)) if parts > 1 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts in _blocks(batches, size):
            for n, keys in enumerate(Grams(texts, order).keys, 1):
                keys, counts = np.unique(keys, return_counts=True)
                part = keys // width if width else np.zeros(len(keys), dtype=np.uint64)
                names, starts = np.unique(part, return_index=True)
                ends = [*starts[1:].tolist(), len(keys)][:len(names)]
                yield _batch([
                    (block, int(name), n, _packed(keys[a:b]), _planes(counts[a:b].astype("<u4")), None)
                    for name, a, b in zip(names, starts.tolist(), ends, strict=True)
                ])

    return docs.mapInArrow(run, _ROWS)


def _answered(asked: DataFrame) -> DataFrame:
    """The same rows with the totals over all blocks in place of the n-grams."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        keys = [_unpacked(row[3]) for row in rows]
        counts = np.concatenate([_numbers(row[4], "<u4") for row in rows])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(inverse, weights=counts).astype("<u8")[inverse]
        ends = np.cumsum([len(own) for own in keys])
        return _batch([
            (row[0], row[1], row[2], None, _planes(totals[end - len(own):end]), None)
            for row, own, end in zip(rows, keys, ends, strict=True)
        ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if rows and rows[0][1:3] != row[1:3]:
                    yield solved(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield solved(rows)

    return (
        asked.repartition(tasks(asked), "part").sortWithinPartitions("part", "size")
        .mapInArrow(run, _ROWS)
    )


def _texts(docs: DataFrame, size: int) -> DataFrame:
    """The texts of every block, some together and compressed, with their lengths and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor()
        for block, ids, texts in _blocks(batches, size):
            for at in range(0, len(ids), _TOGETHER):
                some = texts[at:at + _TOGETHER]
                lengths = np.fromiter(map(len, some), dtype="<u8", count=len(some))
                yield _batch([(
                    block, 0, 0, packer.compress(b"".join(some)), _planes(lengths),
                    ids[at:at + _TOGETHER],
                )])

    return docs.mapInArrow(run, _ROWS)


def _apart(raw: bytes, lengths: bytes) -> list[bytes]:
    joined = zstandard.ZstdDecompressor().decompress(raw)
    ends = np.cumsum(_numbers(lengths, "<u8")).tolist()
    return [joined[start:end] for start, end in zip([0, *ends], ends, strict=False)]


def _log_scores(grams: Grams, totals: list[np.ndarray], backoff: float):
    """Of each document the sum of logarithms without those of N, the number of
    words that need N, and of those that are nowhere else."""
    others = []
    for keys, ends, total in zip(grams.keys, grams.ends, totals, strict=True):
        distinct, inverse = np.unique(keys, return_inverse=True)
        if len(distinct) != len(total):
            raise ValueError("a block was read in another order; store the documents first")
        pairs = grams.owner[ends].astype(np.int64) * len(distinct) + inverse
        _, same, own = np.unique(pairs, return_inverse=True, return_counts=True)
        del pairs, distinct
        left = np.zeros(grams.total, dtype=np.int64)
        left[ends] = total[inverse].astype(np.int64) - own[same]
        others.append(left)
    order = len(others)
    longest = np.minimum(grams.place + 1, order)
    score = np.zeros(grams.total)
    open_ = np.ones(grams.total, dtype=bool)
    for size in range(order, 1, -1):
        hit = np.flatnonzero(open_ & (grams.place >= size - 1) & (others[size - 1] > 0))
        score[hit] = (
            np.log(others[size - 1][hit]) - np.log(others[size - 2][hit - 1])
            + (longest[hit] - size) * math.log(backoff)
        )
        open_[hit] = False
    known = open_ & (others[0] > 0)
    score[known] = np.log(others[0][known]) + (longest[known] - 1) * math.log(backoff)
    unseen = open_ & ~known
    score[unseen] = longest[unseen] * math.log(backoff)
    count = len(grams.lengths)
    return (
        np.bincount(grams.owner, weights=score, minlength=count).astype(np.float64),
        np.bincount(grams.owner, weights=open_, minlength=count).astype(np.int64),
        np.bincount(grams.owner, weights=unseen, minlength=count).astype(np.int64),
    )


def _summed(rows: DataFrame, order: int, backoff: float) -> DataFrame:
    """doc_id, words, partial score, words that need N, unseen words."""

    def solved(ids: list, texts: list, answers: dict[int, list[bytes]]) -> pa.RecordBatch:
        grams = Grams(texts, order)
        totals = [
            np.concatenate([_numbers(raw, "<u8") for raw in answers.get(n, [])] or
                           [np.zeros(0, dtype="<u8")]) for n in range(1, order + 1)
        ]
        score, single, unseen = _log_scores(grams, totals, backoff)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(grams.lengths), pa.array(score),
             pa.array(single), pa.array(unseen)],
            ["doc_id", "words", "partial", "single", "unseen"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, answers = None, [], [], {}
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if row[0] != block:
                    if ids:
                        yield solved(ids, texts, answers)
                    block, ids, texts, answers = row[0], [], [], {}
                if row[2]:
                    answers.setdefault(row[2], []).append(row[4])
                else:
                    ids.extend(row[5])
                    texts.extend(_apart(row[3], row[4]))
        if ids:
            yield solved(ids, texts, answers)

    return (
        rows.repartition(tasks(rows), "block").sortWithinPartitions("block", "size", "part")
        .mapInArrow(run, "doc_id bigint, words bigint, partial double, single bigint, unseen bigint")
    )


def scores(
    docs: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER,
    backoff: float = BACKOFF, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, words, score (natural logarithm), mean (a word), backed_off and unseen words."""
    rows = docs.select(
        named(key).cast("bigint").alias("id"), whole(named(text)).cast("binary").alias("raw")
    )
    answers = _answered(_asked(rows, order, tasks(docs), block_bytes))
    found = stored(
        _summed(_texts(rows, block_bytes).unionByName(answers), order, backoff)
    )
    corpus = found.agg(F.coalesce(F.sum("words"), F.lit(0))).scalar()
    rest = F.greatest(corpus - F.col("words"), F.lit(1)).cast("double")
    score = F.col("partial") - F.col("single") * F.log(rest)
    return found.select(
        "doc_id", "words", F.round(score, 6).alias("score"),
        F.round(F.when(F.col("words") > 0, score / F.col("words")).otherwise(0.0), 6).alias("mean"),
        "unseen",
    )
