"""Near duplicates by SimHash and an index of fingerprint bytes.

Two 64-bit fingerprints that differ in at most ``d`` bits agree in at least
``8 - d`` of their 8 bytes, position by position.  Tallying shared bytes over
the lists of single bytes would compare a 32nd of all pairs.  The index therefore
holds, for each fingerprint, the combinations of ``8 - d`` positioned bytes: two
fingerprints meet in it exactly if their tally reaches the guaranteed minimum.
Those that meet are verified by counting the bits in which they differ.

* Copies cost nothing: the index holds distinct fingerprints.
* Of a list of the index only a tree of verified links is put out, not all
  pairs: documents are grouped by whom they can reach.
* A list of more than ``LIST_LIMIT`` fingerprints is dealt out again over cells, each
  of which holds two parts of the list, so that any two members meet in one of
  them.  Nothing is dropped.
* Words are longest runs of characters other than ASCII white space, of the text
  with A-Z lower-cased.  A text of fewer words than a shingle has is one shingle; null
  counts as the empty text.  Without words the fingerprint is 0, and it is linked
  like any other.
* Rows that repeat an id keep their own fingerprint; a null id is never the
  smallest of a group unless all are null.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import fresh, in_small_batches, named, tasks, whole
from kontor.llm.components import components
from kontor.session import stored

SHINGLE = 4
DISTANCE = 4
LIST_LIMIT = 4096
_SEED = 42
_FAN_OUT = 16
_PIECE = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words, in lists from some megabytes of text each."""
    start = 0
    while start < len(raw):
        stop = start + _PIECE
        if stop < len(raw):
            cut = _SPACE.search(raw, stop)
            stop = cut.start() if cut else len(raw)
        yield raw[start:stop].split()
        start = max(stop, start + 1)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text in UTF-8, as a signed 64-bit number."""
    ones, total, words = np.zeros(64, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for more in _pieces(raw.lower()):
        words += more
        count = len(words) - shingle + 1
        if count < 1:
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[:count].tolist()
        spans = zip(starts, ends[shingle - 1:].tolist(), strict=True)
        hashes = np.fromiter(
            (digest(joined[a:b], _SEED) for a, b in spans), dtype="<u8", count=count
        )
        for at in range(0, count, 1 << 16):
            part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += count
        words = words[count:]
    if not total and words:
        ones = np.unpackbits(
            np.array([digest(b" ".join(words), _SEED)], dtype="<u8").view(np.uint8),
            bitorder="little",
        ).astype(np.int64)
        total = 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE
) -> DataFrame:
    """id, mark (a hash of the text) and print of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(raw.as_buffer().to_pybytes(), shingle) for raw in batch["raw"]]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["mark"], pa.array(found, pa.int64())], ["id", "mark", "print"]
            )

    body = whole(named(text))
    rows = in_small_batches(docs).select(
        named(key).cast("bigint").alias("id"), F.xxhash64(body).alias("mark"),
        body.cast("binary").alias("raw"),
    )
    return rows.mapInArrow(run, "id bigint, mark bigint, print bigint")


def _mixed(values: np.ndarray) -> np.ndarray:
    """Evenly spread 64-bit numbers, one to one."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def index(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """entry, print: the combinations of positioned bytes of every fingerprint."""
    masks = [
        sum(0xFF << (8 * at) for at in places) for places in combinations(range(8), 8 - distance)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["print"].to_numpy(zero_copy_only=False).view(np.uint64)
            for at, mask in enumerate(masks):
                salt = _mixed(np.array([at + 1], dtype=np.uint64))
                entry = _mixed(values & np.uint64(mask)) ^ salt
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry.view(np.int64)), batch["print"]], ["entry", "print"]
                )

    return prints.select("print").mapInArrow(run, "entry bigint, print bigint")


def _tree(members: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected by links of ``distance`` bits or less.

    No member gets more than ``_FAN_OUT`` + 1 links.
    """
    rest = np.unique(members)
    while len(rest) > 1:
        reached, frontier, rest = [rest[:1]], rest[:1], rest[1:]
        while len(frontier) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            for at in range(0, len(frontier), 64):
                apart = np.bitwise_count(frontier[at:at + 64, None] ^ rest[None, :])
                near |= (apart <= distance).any(axis=0)
            frontier, rest = rest[near], rest[~near]
            reached.append(frontier)
        group = np.concatenate(reached).view(np.int64).tolist()
        for place in range(1, len(group)):
            yield group[place], group[(place - 1) // _FAN_OUT]


def _linked(entries: DataFrame, distance: int, limit: int) -> DataFrame:
    """a, b, entry: links, and with null ``b`` the members of lists beyond the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shown(links: list[tuple[int, int, int | None]]) -> pa.RecordBatch:
            columns = list(zip(*links, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns], ["a", "b", "entry"]
            )

        def solved(keys: np.ndarray, values: np.ndarray) -> list[tuple]:
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts = np.concatenate([[0], edges])
            sizes = np.diff(np.concatenate([starts, [len(keys)]]))
            links: list[tuple] = []
            twos = starts[sizes == 2]
            apart = np.bitwise_count(values[twos] ^ values[twos + 1])
            twos = twos[(apart > 0) & (apart <= distance)]
            signed = values.view(np.int64)
            links += [(int(signed[at]), int(signed[at + 1]), None) for at in twos]
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                if size > limit:
                    entry = int(keys[start])
                    links += [(int(x), None, entry) for x in signed[start:start + size]]
                else:
                    links += [(*x, None) for x in _tree(values[start:start + size], distance)]
            return links

        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        large: int | None = None  # the list that is being passed on
        for batch in batches:
            entry = batch["entry"].to_numpy(zero_copy_only=False)
            value = batch["print"].to_numpy(zero_copy_only=False).view(np.uint64)
            if large is not None:
                other = np.flatnonzero(entry != large)
                cut = int(other[0]) if len(other) else len(entry)
                yield shown([(int(x), None, large) for x in value[:cut].view(np.int64)])
                entry, value = entry[cut:], value[cut:]
                if not len(entry):
                    continue
                large = None
            keys, values = np.concatenate([keys, entry]), np.concatenate([values, value])
            if not len(keys):
                continue
            other = np.flatnonzero(keys != keys[-1])  # the last list may go on
            last = int(other[-1]) + 1 if len(other) else 0
            if last:
                yield shown(solved(keys[:last], values[:last]))
                keys, values = keys[last:], values[last:]
            if len(keys) > limit:
                large = int(keys[0])
                yield shown([(int(x), None, large) for x in values.view(np.int64)])
                keys, values = keys[:0], values[:0]
        if len(keys):
            yield shown(solved(keys, values))

    return (
        entries.repartition(tasks(entries), "entry").sortWithinPartitions("entry")
        .mapInArrow(run, "a bigint, b bigint, entry bigint")
    )


def links(prints: DataFrame, distance: int = DISTANCE, limit: int = LIST_LIMIT) -> DataFrame:
    """a, b: links that connect the distinct fingerprints of each group."""
    found = stored(_linked(index(prints, distance), distance, limit))
    large = found.filter("b IS NULL").select("entry", F.col("a").alias("print"))
    parts = stored(
        large.groupBy("entry").agg(F.count(F.lit(1)).alias("members"))
        .select(F.col("entry").alias("of"), F.expr(f"members DIV {limit} + 1").alias("parts"))
    )
    cells = (
        large.join(parts, F.col("entry") == F.col("of"))
        .withColumn("own", F.pmod(F.xxhash64("print", "entry"), F.col("parts")))
        .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
        .select(
            F.xxhash64("entry", F.least("own", "other"), F.greatest("own", "other"))
            .alias("entry"), "print",
        )
    )
    # A cell holds two parts of some ``limit`` members, so nothing more is put off.
    dealt = _linked(cells, distance, 1 << 62)
    return found.filter("b IS NOT NULL").select("a", "b").unionByName(
        dealt.filter("b IS NOT NULL").select("a", "b")
    )


def near_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id",
    shingle: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (the smallest id of the group), mark."""
    prints = stored(fingerprints(docs, text, key, shingle))
    nodes = stored(prints.groupBy("print").agg(F.min("id").alias("first")))
    roots = stored(components(links(nodes, distance)))
    linked = nodes.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    smallest = stored(
        linked.groupBy("root").agg(F.min("first").alias("component_id"))
        .withColumnRenamed("root", "of")
    )
    named_groups = stored(
        linked.join(smallest, F.col("root") == F.col("of"))
        .select(F.col("print").alias("shown"), "component_id")
    )
    return prints.join(named_groups, F.col("print") == F.col("shown")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id", "mark",
    )


def drop_near(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One document of each group, all columns as they are: the one of smallest id.

    Rows that repeat both id and text stay or go together, and a null id stays
    only in a group without other ids.
    """
    groups = near_groups(docs, text, key, **options)
    gone = stored(
        groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_id"), "mark").distinct()
    )
    mark, = fresh(docs, "_mark")
    marked = docs.withColumn(mark, F.xxhash64(whole(named(text))))
    same = (named(mark) == gone["mark"]) & named(key).cast("bigint").eqNullSafe(gone["_id"])
    return marked.join(gone, same, "left_anti").drop(mark)
