"""Importance resampling towards a target distribution.

A text's features are its words and pairs of adjacent words, counted in buckets by
their CRC-32.  A bucket's gain says how much more usual it is in the target than in all
documents; a document's weight is the mean gain of its features.  Weights are
perturbed by Gumbel noise from a hash of the id, so that the highest scores are a
sample without replacement in proportion to the weights.

* Head and tail: the words and pairs that are frequent in the documents are broadcast, the
  words with the CRC state behind their last byte and the pairs with their bucket.  All other
  features take their CRC byte by byte, pairs from the state of their first word.  Both give the
  same buckets; the head, bounded by ``HEAD``, only saves time.  It is counted in all
  documents, of the ``SEEN`` most frequent of every piece of text.
* Totals of buckets are exact: a task adds up its own, and 10,000 rows a task meet.
* Whole texts are read, long ones in segments that overlap by a word, so memory is bounded.
* Only ids and scores are sorted, by ranges; no ranking sees all rows in one task.
* A null text has no word.  A null id is hashed as ``7:null`` and comes last in ties.
  Rows that repeat are ranked one by one.  Without documents there is no row; without
  a target every gain follows from the documents alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import named, whole
from kontor.operators.numbering import number_rows
from kontor.session import stored

BUCKETS = 10_000
#: Words, and pairs, that are broadcast; and those counted in each piece of text.
HEAD = 1 << 15
SEEN = 2048
#: Bytes of text that are taken apart together; a longer text goes in segments.
TOGETHER = 4 << 20
LEAST_WORDS = 20
SHARE = 25
SEED = 7
#: Longer words take their CRC one by one.
_LONG = 64


def _byte_table() -> np.ndarray:
    """Bytes of words as they are, A-Z in lower case; 0 for all that parts words."""
    table = np.arange(256, dtype=np.uint8)
    letters = np.arange(ord("A"), ord("Z") + 1)
    table[:0x30] = table[0x3A:0x61] = table[0x7B:0x80] = 0
    table[letters] = letters + 32
    return table


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def crc_states(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, states: np.ndarray
) -> np.ndarray:
    """CRC-32 after each slice of ``data``, continued from the CRCs in ``states``."""
    table, found = _crc_table(), states.astype(np.uint32)
    for at in np.flatnonzero(sizes > _LONG).tolist():
        held = memoryview(data)[int(starts[at]):int(starts[at] + sizes[at])]
        found[at] = zlib.crc32(held, int(found[at]))
    short = np.minimum(sizes, _LONG).astype(np.uint8)
    short[sizes > _LONG] = 0
    order = np.argsort(_LONG - short, kind="stable")
    reach = len(order) - np.searchsorted(short[order][::-1], np.arange(1, _LONG + 1))
    begin, state = starts[order].astype(np.int32), ~found[order]
    for step, count in enumerate(reach.tolist()):
        if not count:
            break
        now = state[:count]
        state[:count] = table[(now ^ data[begin[:count] + step]) & 255] ^ now >> 8
    found[order] = ~state
    return found


class Head:
    """Frequent words with their CRCs, and frequent pairs of them with their buckets."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]) -> None:
        self.words = pa.array(words, pa.binary())
        self.states = np.array([zlib.crc32(word) for word in words], dtype=np.uint32)
        place = {word: at for at, word in enumerate(words)}
        known = [(place[a] << 32 | place[b], zlib.crc32(b" " + b, int(self.states[place[a]])))
                 for a, b in pairs if a in place and b in place]
        codes = np.array([code for code, _ in known], dtype=np.int64)
        order = np.argsort(codes)
        self.pairs = codes[order]
        self.buckets = (np.array([crc for _, crc in known], dtype=np.int64) % BUCKETS)[order]


def _head(shared) -> Head:
    """The head from its broadcast fields, which travel without this package."""
    own = object.__new__(Head)
    vars(own).update(shared.value)
    return own


class Words:
    """The words of some texts: where they are, and which are equal."""

    def __init__(self, data: np.ndarray, ends: np.ndarray) -> None:
        """``data`` are bytes by ``_byte_table``; each text ends with a 0, before ``ends``."""
        self.data = data
        inside = data != 0
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts = edge[::2]
        self.sizes = edge[1::2] - self.starts
        self.of = np.searchsorted(ends, self.starts, "right")
        offsets = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int32)
        self.all = pa.Array.from_buffers(
            pa.binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        self.codes = self.all.indices.to_numpy(zero_copy_only=False)
        #: Places of first words of pairs.
        self.first = np.flatnonzero(self.of[1:] == self.of[:-1])

    def crcs(self, head: Head) -> tuple[np.ndarray, np.ndarray]:
        """CRC of each word, and of each pair modulo ``BUCKETS``."""
        distinct = self.all.dictionary
        place = pc.index_in(distinct, head.words).fill_null(-1).to_numpy(zero_copy_only=False)
        state = np.zeros(len(distinct), dtype=np.uint32)
        state[place >= 0] = head.states[place[place >= 0]]
        tail = np.flatnonzero(place < 0)
        offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int32)[:len(distinct) + 1]
        bytes_ = np.frombuffer(distinct.buffers()[2] or b"", dtype=np.uint8)
        state[tail] = crc_states(
            bytes_, offsets[tail], np.diff(offsets)[tail], np.zeros(len(tail), dtype=np.uint32)
        )
        words = state[self.codes]
        code = place[self.codes].astype(np.int64)
        one, two = code[self.first], code[self.first + 1]
        both = one << 32 | two
        at = np.minimum(np.searchsorted(head.pairs, both), max(len(head.pairs) - 1, 0))
        pairs = np.zeros(len(both), dtype=np.int64)
        known = (one >= 0) & (two >= 0)
        if len(head.pairs):
            known &= head.pairs[at] == both
            pairs[known] = head.buckets[at[known]]
        else:
            known[:] = False
        rest = np.flatnonzero(~known)
        after = crc_states(
            np.array([32], dtype=np.uint8), np.zeros(len(rest), dtype=np.int32),
            np.ones(len(rest), dtype=np.int64), words[self.first[rest]],
        )
        second = self.first[rest] + 1
        pairs[rest] = crc_states(self.data, self.starts[second], self.sizes[second], after) % BUCKETS
        return words, pairs


def segments(data: bytes) -> Iterator[tuple[int, int]]:
    """Slices of one long text, each from the last word of the slice before.

    Words are parted by one 0.  A slice has two words at least, so each begins later.
    """
    begin = 0
    while len(data) - begin > TOGETHER:
        first = data.find(0, begin)
        second = data.find(0, first + 1) if first >= 0 else -1
        if second < 0:
            break
        cut = max(second, data.rfind(0, begin, begin + TOGETHER))
        yield begin, cut
        begin = data.rfind(0, begin, cut) + 1
    yield begin, len(data)


def taken_apart(
    texts: pa.Array,
) -> Iterator[tuple[int, int, bool, np.ndarray, np.ndarray]]:
    """first text, one behind the last, whether the first word was there already, bytes, ends."""
    table = _byte_table()
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.cumsum(sizes + 1) // TOGETHER
    bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
    for first, last in zip(bounds, bounds[1:], strict=False):
        if last == first + 1 and sizes[first] > TOGETHER:
            data = texts[first].as_py().encode().translate(table.tobytes())
            data = re.sub(rb"\0+", b"\0", data).strip(b"\0")
            for begin, end in segments(data):
                part = np.frombuffer(data[begin:end] + b"\0", dtype=np.uint8)
                yield first, last, begin > 0, part, np.array([len(part)])
        elif last > first:
            closed = pc.binary_join_element_wise(texts.slice(first, last - first), "", "\n")
            offsets = np.frombuffer(closed.buffers()[1], dtype=np.int32)[
                closed.offset:closed.offset + len(closed) + 1
            ]
            raw = np.frombuffer(closed.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
            yield first, last, False, table[raw], (offsets[1:] - offsets[0]).astype(np.int64)


def frequent(docs: DataFrame, text: str, head: int = HEAD) -> Head:
    """The head of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, data, ends in taken_apart(batch["text"]):
                words = Words(data, ends)
                count = np.bincount(words.codes, minlength=len(words.all.dictionary))
                pair, pairs = np.unique(
                    words.codes[words.first].astype(np.int64) << 32 | words.codes[words.first + 1],
                    return_counts=True,
                )
                one = np.argsort(-count, kind="stable")[:SEEN]
                two = np.argsort(-pairs, kind="stable")[:SEEN]
                distinct = words.all.dictionary
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([distinct.take(pa.array(one)),
                                      distinct.take(pa.array(pair[two] >> 32))]),
                    pa.concat_arrays([pa.nulls(len(one), pa.binary()),
                                      distinct.take(pa.array(pair[two] & 0xFFFFFFFF))]),
                    pa.array(np.concatenate([count[one], pairs[two]]).astype(np.int64)),
                ], ["word", "next", "rows"])

    counted = docs.select(whole(named(text)).alias("text")).mapInArrow(
        run, "word binary, next binary, rows bigint"
    ).groupBy("word", "next").agg(F.sum("rows").alias("rows"))
    kept = stored(counted.withColumns({
        "level": F.floor(8 * F.log2("rows")), "pair": F.col("next").isNotNull(),
    }))
    # A few hundred levels of frequency tell which rows are so many that all may be sent.
    levels = kept.groupBy("pair", "level").agg(F.count(F.lit(1)).alias("size")).collect()
    found = []
    for pair in (False, True):
        cut, room = 1 << 20, head
        for row in sorted((r for r in levels if r["pair"] == pair), key=lambda r: -r["level"]):
            room -= row["size"]
            if room < 0:
                break
            cut = row["level"]
        found.append(kept.filter((F.col("pair") == pair) & (F.col("level") >= cut)).collect())
    words, pairs = found
    return Head([bytes(row["word"]) for row in words],
                [(bytes(row["word"]), bytes(row["next"])) for row in pairs])


def totals(docs: DataFrame, text: str, shared) -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = _head(shared)
        found = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, again, data, ends in taken_apart(batch["text"]):
                words, pairs = Words(data, ends).crcs(head)
                found += np.bincount(words[int(again):] % BUCKETS, minlength=BUCKETS)
                found += np.bincount(pairs, minlength=BUCKETS)
        own = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(found[own])], ["bucket", "n"])

    counted = docs.select(whole(named(text)).alias("text")).mapInArrow(
        run, "bucket bigint, n bigint"
    ).groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.collect():  # at most BUCKETS rows
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the logarithm of how much likelier a bucket is in the target."""
    ratio = (target + 1.0) * (source.sum() + float(BUCKETS)) / (
        (source + 1.0) * (target.sum() + float(BUCKETS))
    )
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, text: str, key: str, shared, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = _head(shared)
        for batch in batches:
            count = np.zeros(len(batch), dtype=np.int64)
            total = np.zeros(len(batch), dtype=np.int64)
            for first, last, again, data, ends in taken_apart(batch["text"]):
                words = Words(data, ends)
                crcs, pairs = words.crcs(head)
                own, drawn = words.of[int(again):], gain[crcs[int(again):] % BUCKETS]
                part = slice(first, last)
                count[part] += np.bincount(own, minlength=last - first)
                total[part] += np.bincount(own, drawn, last - first).astype(np.int64)
                total[part] += np.bincount(
                    words.of[words.first], gain[pairs], last - first
                ).astype(np.int64)
            features = np.maximum(2 * count - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(count), pa.array(features),
                 pa.array(total // np.maximum(features, 1))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.select(
        named(key).cast("bigint").alias("id"), whole(named(text)).alias("text")
    ).mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resampled(
    docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id",
    target_text: str = "text", share: int = SHARE, least: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where not drawn."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(frequent(docs, text)))
    gain = gains(totals(docs, text, shared), totals(target, target_text, shared))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    digest = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), name), 256), 1, 8)
    uniform = (F.conv(digest, 16, 10).cast("bigint") + 0.5) / 4294967296
    scored = stored(weighted(docs, text, key, shared, gain).select(
        "doc_id", "n_features", "weight",
        (F.col("weight") + F.floor(-1000 * F.ln(-F.ln(uniform)))).alias("score"),
        (F.col("n_words") < least).alias("short"),
    ))
    shared.unpersist()
    drawn = share * scored.filter(~F.col("short")).count() // 100
    order = [F.col("short"), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    placed = number_rows(scored, order, "rank")
    return placed.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"),
    )
