"""Token ids in binary files with Elias-Fano document boundaries.

A file holds the ids of many documents in a row, in ascending order of document id, and
behind them two monotone sequences in Elias-Fano form: where each document
begins, and the document ids.  Either takes about two bits and the logarithm of the
mean gap for each document; a select structure gives any of its values from a few bytes.

File, all little-endian: ids of two or four bytes; boundaries; document ids; footer (``FOOTER``).
A sequence is: its low bits, its high bits in unary, and one position of 64 bits for
every ``SAMPLE``-th set bit.

* Every id is encoded once, every document shuffled once, by ranges of document ids.
  The ranges follow from the ids alone, so a repeated task writes the same file; it
  does so under a new name, and only files named by tasks that ended count.
* Ids are written as they come; a task holds one batch and its boundaries.  Reading
  takes ``BLOCK`` ids at a time, so long documents and large files need no room.
* Rows that repeat a document id are spread over ranges and follow one another in an
  order by their text.  Null ids come first.  A null text is empty and gives
  the end id alone.  An empty table gives no file and no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import named, tasks, whole
from kontor.llm.tokens import encoder, pieces
from kontor.session import application_folder, stored

END_ID = 1
#: Set bits from one stored position to the next.
SAMPLE = 256
#: Ids that are read at once.
BLOCK = 1 << 20
MAGIC = b"KTOKENS1"
#: Documents, ids, bytes of an id, null document ids, first document id that isn't null; of either
#: sequence the low bits of a value and the bytes of its three parts; magic.
FOOTER = "<QQQQq4Q4Q8s"


class EliasFano:
    """A sequence of ascending whole numbers from 0, such as offsets.

    A value's ``low`` lower bits are stored as they are.  The rest is stored by a set bit
    for each value, behind as many clear bits as the rest has grown since the value before.
    """

    def __init__(self, low: int, parts: tuple[memoryview, memoryview, memoryview]) -> None:
        self.low = low
        self.lower, self.upper, samples = (np.frombuffer(part, dtype=np.uint8) for part in parts)
        self.samples = samples.view("<u8")

    @staticmethod
    def encode(values: np.ndarray) -> tuple[int, tuple[bytes, bytes, bytes]]:
        values = values.astype(np.uint64)
        count = len(values)
        mean = int(values[-1]) // count if count else 0
        low = max(0, mean.bit_length() - 1)
        places = (values >> np.uint64(low)).astype(np.int64) + np.arange(count)
        upper = np.zeros(-(-(int(places[-1]) + 1) // 8) if count else 0, dtype=np.uint8)
        np.bitwise_or.at(upper, places >> 3, np.left_shift(1, places & 7).astype(np.uint8))
        bits = np.empty((count, low), dtype=np.uint8)
        for at in range(low):
            bits[:, at] = (values >> np.uint64(at)) & np.uint64(1)
        lower = np.packbits(bits.ravel(), bitorder="little")
        samples = places[::SAMPLE].astype("<u8")
        return low, (lower.tobytes(), upper.tobytes(), samples.tobytes())

    def select(self, first: int, last: int) -> np.ndarray:
        """Values number ``first`` up to, not including, ``last``; only their bytes are read."""
        if last <= first:
            return np.zeros(0, dtype=np.uint64)
        sample, beyond = first // SAMPLE, (last - 1) // SAMPLE + 1
        begin = int(self.samples[sample]) // 8
        end = int(self.samples[beyond]) // 8 + 1 if beyond < len(self.samples) else len(self.upper)
        bits = np.unpackbits(self.upper[begin:end], bitorder="little")
        bits[:int(self.samples[sample]) - 8 * begin] = 0
        skipped = first - sample * SAMPLE
        places = np.flatnonzero(bits)[skipped:skipped + last - first] + 8 * begin
        high = (places - np.arange(first, last)).astype(np.uint64)
        start = first * self.low
        stop = last * self.low
        lower = np.unpackbits(self.lower[start // 8:-(-stop // 8)], bitorder="little")
        lower = lower[start % 8:start % 8 + stop - start].reshape(last - first, self.low)
        found = high << np.uint64(self.low)
        for at in range(self.low):
            found |= lower[:, at].astype(np.uint64) << np.uint64(at)
        return found


class TokenWriter:
    """Writes one file, document by document, in ascending order of their ids."""

    def __init__(self, stream, width: int) -> None:
        self.stream, self.width = stream, width
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.nulls = self.size = 0

    def add(self, keys: np.ndarray, nulls: int, counts: np.ndarray, ids) -> None:
        """Documents with ``counts`` ids each; the first ``nulls`` of them have no id."""
        self.stream.write(ids)
        self.keys.append(keys[nulls:])
        self.counts.append(counts)
        self.nulls += nulls
        self.size += int(counts.sum())

    def close(self) -> tuple[int, int]:
        """Writes what follows the ids; returns documents and ids."""
        counts = np.concatenate([np.zeros(0, dtype=np.int64), *self.counts])
        keys = np.concatenate([np.zeros(0, dtype=np.int64), *self.keys])
        base = int(keys[0]) if len(keys) else 0
        starts = np.cumsum(counts) - counts
        found = [EliasFano.encode(starts),
                 EliasFano.encode(keys.view(np.uint64) - np.int64(base).view(np.uint64))]
        numbers = []
        for low, parts in found:
            numbers += [low, *map(len, parts)]
            for part in parts:
                self.stream.write(part)
        self.stream.write(struct.pack(
            FOOTER, len(counts), self.size, self.width, self.nulls, base, *numbers, MAGIC
        ))
        self.stream.close()
        return len(counts), self.size


class TokenFile:
    """A file for reading: documents by number, or one after the other."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        footer = struct.calcsize(FOOTER)
        held = struct.unpack(FOOTER, file.read_at(footer, size - footer))
        self.documents, self.size, self.width, self.nulls, self.base, *numbers, magic = held
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        at, self.parts = self.size * self.width, []
        for low, *sizes in (numbers[:4], numbers[4:]):
            parts = []
            for part in sizes:
                parts.append(file.read_at(part, at))
                at += part
            self.parts.append(EliasFano(low, tuple(parts)))
        self.starts, self.keys = self.parts

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Where the documents of these numbers begin, and where the last one ends."""
        if last < self.documents:
            return self.starts.select(first, last + 1).astype(np.int64)
        return np.append(self.starts.select(first, last).astype(np.int64), self.size)

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        known = self.keys.select(max(first - self.nulls, 0), max(last - self.nulls, 0))
        signed = (known + np.int64(self.base).view(np.uint64)).view(np.int64)
        return [None] * (last - first - len(known)) + signed.tolist()

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids of these places, 32 bits each."""
        raw = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4", copy=False)

    def __len__(self) -> int:
        return self.documents

    def __getitem__(self, number: int) -> np.ndarray:
        begin, end = self.bounds(number, number + 1).tolist()
        return self.ids(begin, end)

    def digests(self, rows: int = 1024) -> Iterator[tuple[list, list, list, list]]:
        """doc_ids, starts, sizes and checksums, some documents at a time."""
        for first in range(0, self.documents, rows):
            last = min(first + rows, self.documents)
            bounds = self.bounds(first, last)
            checks = [0] * (last - first)
            at = 0
            while at < last - first:
                # As many documents as fit into a block, or a part of one that doesn't.
                stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1)
                begin, end = int(bounds[at]), int(bounds[stop])
                if end - begin <= BLOCK:
                    held = memoryview(self.ids(begin, end)).cast("B")
                    for n in range(at, stop):
                        checks[n] = zlib.crc32(
                            held[4 * (int(bounds[n]) - begin):4 * (int(bounds[n + 1]) - begin)]
                        )
                else:
                    for part in range(begin, end, BLOCK):
                        checks[at] = zlib.crc32(self.ids(part, min(part + BLOCK, end)), checks[at])
                at = stop
            yield self.doc_ids(first, last), bounds[:-1].tolist(), np.diff(bounds).tolist(), checks


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


def write(
    docs: DataFrame, tokenizer: str, folder: str, text: str = "text", key: str = "doc_id",
    end_id: int = END_ID,
) -> DataFrame:
    """Write all documents below ``folder``, which all executors share.

    Returns one row per file: part, path, documents, ids.  Parts ascend with document ids.
    """
    count = tasks(docs)
    rows = docs.select(named(key).cast("bigint").alias("id"), whole(named(text)).alias("text"))
    bounds = rows.agg(F.percentile_approx(
        F.coalesce("id", F.lit(-(1 << 63))), [at / count for at in range(1, count)] or [0.5]
    )).first()[0]
    edges = np.array(bounds or [], dtype=np.int64)[:count - 1]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        width = "<u2" if max(own.size, end_id + 1) <= 1 << 16 else "<u4"
        for batch in (part for batch in batches for part in pieces(batch)):
            plain, sizes = own.encode(batch["text"])
            ends = np.cumsum(sizes + 1)
            ids = np.full(int(ends[-1]), end_id, dtype=width)
            inner = np.ones(len(ids), dtype=bool)
            inner[ends - 1] = False
            ids[inner] = plain
            offsets = (np.concatenate([[0], ends]) * ids.itemsize).astype(np.int64)
            raw = pa.Array.from_buffers(
                pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
            ).cast(pa.binary())
            # An id that fills several ranges is spread over them by its text.
            keys = batch["id"].fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(edges, keys), np.searchsorted(edges, keys, "right")
            ties = np.zeros(len(keys), dtype=np.int64)
            for at in np.flatnonzero(high > low):
                ties[at] = zlib.crc32(batch["text"][at].as_py().encode() + batch["seen"][at].as_py())
            parts = low + ((high - low + 1) * ties >> 32)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(parts.astype(np.int32)), pa.array(ties),
                 pa.array(sizes + 1), raw],
                ["id", "part", "tie", "tokens", "ids"],
            )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                part = batch["part"][0].as_py()
                size = batch["tokens"][0].as_py()
                path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.tokens"
                system, place = _filesystem(path)
                width = len(batch["ids"][0].as_py()) // size
                writer = TokenWriter(system.open_output_stream(place), width)
            ids = batch["ids"]
            offsets = np.frombuffer(ids.buffers()[1], dtype=np.int32)[
                ids.offset:ids.offset + len(ids) + 1
            ]
            data = memoryview(ids.buffers()[2])[int(offsets[0]):int(offsets[-1])]
            writer.add(
                batch["id"].fill_null(0).to_numpy(zero_copy_only=False), batch["id"].null_count,
                batch["tokens"].to_numpy(zero_copy_only=False), data,
            )
        if writer is not None:
            documents, size = writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([path]), pa.array([documents]),
                 pa.array([size])],
                ["part", "path", "documents", "ids"],
            )

    system, place = _filesystem(folder)
    system.create_dir(place, recursive=True)
    # Rows that repeat an id and a text are told apart by where they were read.
    seen = F.encode(F.monotonically_increasing_id().cast("string"), "utf-8")
    return stored(
        rows.select("*", seen.alias("seen"))
        .mapInArrow(encoded, "id bigint, part int, tie bigint, tokens bigint, ids binary")
        .repartitionById(count, "part")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
        .mapInArrow(written, "part int, path string, documents bigint, ids bigint")
    )


def read(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*[batch[name].to_pylist() for name in ("path", "first")]):
                system, place = _filesystem(path)
                with system.open_input_file(place) as file:
                    for names, starts, sizes, checks in TokenFile(file).digests():
                        yield pa.RecordBatch.from_arrays([
                            pa.array(names, pa.int64()),
                            pa.array(np.array(starts, dtype=np.int64) + first),
                            pa.array(sizes, pa.int64()), pa.array(checks, pa.int64()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row per file, as many as there are shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    return placed.repartitionById(tasks(files), "part").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def through_files(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents into files of this application, and read them back."""
    folder = f"{application_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read(write(docs, tokenizer, folder))
