"""Packing documents into sequences along a Hilbert curve.

A document becomes token ids, closed by an end id.  Its bag of tokens is projected
to a few dimensions by hashed signs; the Hilbert key of that point puts documents of
like content next to each other.  Documents are range-sorted by this key, laid
end to end, and cut into sequences.

* Sequences are full, ``LENGTH`` ids.  What is left at the very end is cut into
  powers of two, which need no padding, so nothing is padded.
* A document may be cut anywhere; each of its ids lies in exactly one piece.
* Ties of the key go by id; rows that repeat are packed one by one.  A null text
  is empty and gives the end id alone.  An empty table gives an empty result.
* Texts are encoded once and stored; ids, not texts, are shuffled.  Ranges are stored
  before their offsets are taken, so that a lost executor changes nothing.
* ``tokens`` says how texts are encoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import fresh, in_small_batches, named, tasks, whole
from kontor.llm.tokens import encoder, pieces
from kontor.session import stored

LENGTH = 4096
END_ID = 2
DIMENSIONS = 4
BITS = 12


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points with whole coordinates below 2^bits.

    Skilling's method: undo the curve's turns, then read the bits crosswise.
    """
    x = points.astype(np.int64).T.copy()
    count = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in range(count):
            turned = (x[axis] & bit) != 0
            swapped = np.where(turned, 0, (x[0] ^ x[axis]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swapped)
            if axis:
                x[axis] ^= swapped
    for axis in range(1, count):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where(x[count - 1] & (1 << level), flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(count):
            key = key << 1 | (x[axis] >> level & 1)
    return key


def signs(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A hashed sign, 1 or -1, for each token id and dimension."""
    return (np.random.default_rng(0).integers(0, 2, (dimensions, size)) * 2 - 1).astype(np.float32)


def _curve(ids: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], ends[:-1]])
    means = np.stack([
        np.add.reduceat(line[ids], starts, dtype=np.float64) / (ends - starts) for line in table
    ], axis=1)
    points = np.floor((1 << BITS) / (1 + np.exp(-12 * means)))
    return hilbert_key(np.clip(points, 0, (1 << BITS) - 1), BITS)


def encoded(docs: DataFrame, path: str, text: str, key: str) -> DataFrame:
    """id, curve, tokens, ids (two or four bytes each) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        width = "<u2" if max(own.size, END_ID + 1) <= 1 << 16 else "<u4"
        table = signs(max(own.size, END_ID + 1))
        for batch in (part for batch in batches for part in pieces(batch)):
            plain, sizes = own.encode(batch["text"])
            ends = np.cumsum(sizes + 1)
            ids = np.full(int(ends[-1]), END_ID, dtype=width)
            inner = np.ones(len(ids), dtype=bool)
            inner[ends - 1] = False
            ids[inner] = plain
            offsets = (np.concatenate([[0], ends]) * ids.itemsize).astype(np.int64)
            raw = pa.Array.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(_curve(ids, ends, table)), pa.array(sizes + 1),
                 raw.cast(pa.binary())],
                ["id", "curve", "tokens", "ids"],
            )
        pa.default_memory_pool().release_unused()  # the worker lives on, through other stages

    rows = in_small_batches(docs).select(
        named(key).cast("bigint").alias("id"), whole(named(text)).alias("text")
    )
    return rows.mapInArrow(run, "id bigint, curve bigint, tokens bigint, ids binary")


def _bounds(total: int, length: int) -> list[int]:
    """Where the sequences of what is left after the last full one begin."""
    begin, rest, found = total - total % length, total % length, []
    while rest:
        found.append(begin)
        part = 1 << (rest.bit_length() - 1)
        begin, rest = begin + part, rest - part
    return found


def pack(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", length: int = LENGTH
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, and
    ids, 32-bit little-endian."""
    if length & (length - 1):
        raise ValueError("the length of a sequence must be a power of two")
    tokens = stored(encoded(docs, path, text, key))
    order = ["curve", "id", "tie"]

    def laid(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for part in parts:
            sizes = part["tokens"].to_numpy(zero_copy_only=False)
            begins = done + np.cumsum(sizes) - sizes
            done += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["part"], pa.array(begins), part["tokens"], part["ids"]],
                ["id", "part", "begin", "tokens", "ids"],
            )

    ranges = stored(
        tokens.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(tasks(tokens), *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(laid, "id bigint, part int, begin bigint, tokens bigint, ids binary")
    )
    # One row per range, as many as there are shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("part").agg(F.sum("tokens").alias("tokens")).select(
        F.col("part").alias("of"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first")
    )
    total = int(ranges.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    full, tail = total // length, np.array(_bounds(total, length), dtype=np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch[name].to_pylist() for name in ("id", "begin", "tokens", "ids")]
            for name, begin, count, raw in zip(*columns, strict=True):
                ids = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * count else "<u4")
                ids, at = ids.astype("<u4"), 0
                while at < count:
                    place = begin + at
                    if place < full * length:
                        sequence, first = place // length, place // length * length
                        stop = first + length
                    else:
                        nth = int(np.searchsorted(tail, place, "right")) - 1
                        sequence, first = full + nth, int(tail[nth])
                        stop = int(tail[nth + 1]) if nth + 1 < len(tail) else total
                    size = min(stop - place, count - at)
                    rows.append((name, at, size, count, sequence, place - first,
                                 ids[at:at + size].tobytes()))
                    at += size
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array(column, pa.binary() if at == 6 else pa.int64())
                    for at, column in enumerate(zip(*rows, strict=True))
                ], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return (
        ranges.join(F.broadcast(offsets), F.col("part") == F.col("of"))
        .select("id", (F.col("first") + F.col("begin")).alias("begin"), "tokens", "ids")
        .mapInArrow(
            cut, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, "
            "sequence_id bigint, offset bigint, ids binary",
        )
    )


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    check, = fresh(pieces, "ids_crc32")
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias(check), "doc_tokens", "sequence_id",
        "offset",
    )
