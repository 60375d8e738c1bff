"""Exact duplicates by two passes over a Bloom filter.

The first pass marks, for every text, a few bits of a filter and keeps the bits
that were marked more than once.  The second pass probes this filter: a text
whose bits were all marked repeatedly may have a copy, and only such rows are
shuffled.  All others pass straight through.  What the first pass shuffles are numbers
of bits, counted before, not rows.

* Null counts as the empty text.  Of equal texts the row with the largest id
  stays; a null id is smaller than any other.  Of rows that repeat both id and
  text exactly one stays.
* The filter has ``bits_per_row`` bits a row, between ``LEAST_BITS`` and
  ``MOST_BITS``, so it takes 32 MB at most.  A fuller filter lets more rows
  through to the shuffle; the result is the same.
* Copies are counted before they are shuffled.  A group of any size costs one
  row per task.  The rows of suspected copies meet their group in a join that
  adaptive execution can split.
* An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import fresh, named, whole
from kontor.session import stored

LEAST_BITS = 2**16
MOST_BITS = 2**28


def _positions(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(seed)).bitwiseAND(F.lit(bits - 1)) for seed in range(hashes)]


class RepeatFilter:
    """A Bloom filter of the values of a bigint column that occur more than once."""

    def __init__(self, df: DataFrame, key: str, bits_per_row: int = 16, hashes: int = 2) -> None:
        wanted = max(1, df.count()) * bits_per_row
        self.bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))
        self.hashes = hashes
        marks = (
            df.select(F.explode(F.array(*_positions(named(key), self.bits, hashes))).alias("bit"))
            .groupBy("bit").agg(F.count(F.lit(1)).alias("marks"))
            .filter("marks > 1")
        )
        words = marks.groupBy(F.shiftright("bit", 6).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")
        )
        # One row for each 64 bits, at most MOST_BITS / 64; each task sends one array.
        dense = df.sparkSession.range(self.bits // 64).join(
            words, F.col("id") == F.col("word"), "left"
        )
        gathered = dense.agg(
            F.sort_array(
                F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))
            ).alias("all")
        )
        self.table = stored(gathered.select(F.col("all.bits").alias("words")))

    def might_repeat(self, key: Column) -> Column:
        words = self.table.scalar()
        hit = F.lit(True)
        for bit in _positions(key, self.bits, self.hashes):
            word = F.get(words, F.shiftright(bit, 6).cast("int"))
            hit = hit & (F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return F.coalesce(hit, F.lit(False))


def _short(text: Column) -> Column:
    return F.xxhash64(whole(text))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(whole(text), 256))


def _fingerprints(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Id, short hash and digest of every text, stored: the texts are read once."""
    return stored(docs.select(
        named(key).alias("id"), _short(named(text)).alias("short"),
        _digest(named(text)).alias("digest"), F.monotonically_increasing_id().alias("row"),
    ))


def _groups(suspects: DataFrame) -> DataFrame:
    """Of each digest the row that stays, and the number of rows."""
    return stored(
        suspects.groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("copies"))
        .select(
            F.col("digest").alias("of"), F.col("last.id").alias("keep_id"),
            F.col("last.row").alias("keep_row"), "copies",
        )
    )


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = _fingerprints(docs, text, key)
    repeated = RepeatFilter(prints, "short")
    suspects = prints.filter(repeated.might_repeat(F.col("short")))
    alone = prints.filter(~repeated.might_repeat(F.col("short")))
    groups = _groups(suspects)
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return alone.select(
        F.col("id").alias("doc_id"), F.col("id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), sha,
    ).unionByName(
        suspects.join(groups, F.col("digest") == F.col("of")).select(
            F.col("id").alias("doc_id"), "keep_id", F.col("copies").alias("group_size"),
            (F.col("row") == F.col("keep_row")).alias("kept"), sha,
        )
    )


def drop_exact(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without the copies, all columns as they are.

    Texts that surely occur once are never shuffled.
    """
    prints = _fingerprints(docs, text, key)
    repeated = RepeatFilter(prints, "short")
    groups = _groups(prints.filter(repeated.might_repeat(F.col("short")))).select("of", "keep_id")
    suspect = repeated.might_repeat(_short(named(text)))
    digest, = fresh(docs, "_digest")
    stay = docs.filter(suspect).withColumn(digest, _digest(named(text)))
    same = (named(digest) == groups["of"]) & stay[f"`{key}`"].eqNullSafe(groups["keep_id"])
    stay = stay.join(groups, same, "left_semi").dropDuplicates([digest]).drop(digest)
    return docs.filter(~suspect).unionByName(stay)
