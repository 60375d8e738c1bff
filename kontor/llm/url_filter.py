"""URL rules in a sorted array of digests.

Rules are (host, path, verdict).  Their 64-bit xxhash keys lie in one sorted
array in a file that every executor fetches once and maps into memory; its
Python workers share the pages.  The keys of a URL (its host and the domains
above it, each with the path prefixes that rules have) are hashed in the JVM
and probed by vectorised binary search, and hits are confirmed against the
stored texts, so a collision of digests can't block a page.

* A rule fits its host and all subdomains if the path starts with the rule's
  path.  The longest rule wins; of equal lengths the one with the longer host.
* The host is what lies between the first ``://`` and the next ``/``, ``?``,
  ``#`` or the end, with A-Z lower-cased; the path goes on to ``?``, ``#`` or the
  end.  A null URL, or one without ``://``, has empty ones.
* Without a rule the ``default`` verdict holds.
* The file holds ``MOST_RULES`` rules at most; of more rules, ``by_join`` takes a
  table and joins it.  Of rules repeated with the same host and path, ``allow``
  wins.  An empty table of pages or rules is fine.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.llm.common import named
from kontor.session import shared_folder

MOST_RULES = 5_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(known, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def label_count(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def candidates(host: Column, path: Column, lengths: Sequence[int], most: int) -> Column:
    """Host suffixes of at most ``most`` labels, as many as a rule has, each with the path
    prefixes of the given lengths, as texts; the longest host first."""
    end = F.substring_index(host, ".", -most)
    labels = F.split(end, r"\.", -1)
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda first: F.array_join(F.slice(labels, first, F.size(labels)), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.left(path, F.lit(n))) for n in lengths]),
        lambda prefix: prefix.isNotNull(),
    )
    return F.flatten(
        F.transform(hosts, lambda name: F.transform(prefixes, lambda end: F.concat(name, end)))
    )


class DigestArray:
    """Sorted digests, verdicts, and the rules' texts, in one file."""

    def __init__(self, spark: SparkSession, rules: DataFrame) -> None:
        """``rules`` has host, path and verdict (``allow`` or ``block``)."""
        rules = rules.groupBy(F.concat("host", "path").alias("rule")).agg(
            F.min("verdict").alias("verdict"), F.max(F.length("path")).alias("path_length"),
            F.max(label_count(F.col("host"))).alias("labels"),
        ).filter(F.col("rule").isNotNull())
        if rules.count() > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} rules: use by_join")
        table = rules.select("*", F.xxhash64("rule").alias("digest")).orderBy(
            "digest", "rule"
        ).toPandas()
        self.lengths = sorted({int(n) for n in table["path_length"]}) or [0]
        self.labels = max([int(n) for n in table["labels"]], default=1)
        texts = [rule.encode() for rule in table["rule"]]
        ends = np.cumsum([0, *map(len, texts)], dtype="<i8")
        data = b"".join([
            np.array([len(texts)], dtype="<i8").tobytes(),
            table["digest"].to_numpy(dtype="<i8").tobytes(), ends.tobytes(),
            np.array([verdict == "allow" for verdict in table["verdict"]], dtype="u1").tobytes(),
            *texts,
        ])
        self.name = f"rules-{uuid.uuid4().hex}.bin"
        path = posixpath.join(shared_folder(spark), self.name)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
        for start in range(0, len(data), 1 << 22):
            out.write(bytearray(data[start:start + (1 << 22)]))
        out.close()
        spark.sparkContext.addFile(path)

    def probe(self):
        """A function from (texts, digests) of one URL each to (rule, verdict)."""
        name = self.name

        def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            data = np.memmap(SparkFiles.get(name), dtype="u1", mode="r")
            count = int(data[:8].view("<i8")[0])
            ends_at, marks_at = 8 + 8 * count, 16 + 16 * count
            digests = data[8:ends_at].view("<i8")
            ends = data[ends_at:marks_at].view("<i8")
            allowed = data[marks_at:marks_at + count]
            texts = data[marks_at + count:]

            for keys, hashes in parts:
                sizes = hashes.map(len).to_numpy(dtype=np.int64)
                probes = np.concatenate([np.asarray(x, dtype=np.int64) for x in hashes] or
                                        [np.zeros(0, dtype=np.int64)])
                owner = np.repeat(np.arange(len(sizes)), sizes)
                first = np.cumsum(sizes) - sizes
                place = np.searchsorted(digests, probes)
                found: list[tuple[int, str | None, str | None]] = [(-1, None, None)] * len(sizes)
                known = place < count
                known[known] = digests[place[known]] == probes[known]
                for at in np.flatnonzero(known):
                    row = int(owner[at])
                    key = keys.iloc[row][at - first[row]]
                    here, raw = int(place[at]), key.encode()
                    while here < count and digests[here] == probes[at]:
                        if texts[ends[here]:ends[here + 1]].tobytes() == raw:
                            # Candidates come with the longest host first.
                            if len(key) > found[row][0]:
                                verdict = "allow" if allowed[here] else "block"
                                found[row] = (len(key), key, verdict)
                            break
                        here += 1
                yield pd.DataFrame(
                    {"rule": [x[1] for x in found], "verdict": [x[2] for x in found]}, dtype=object
                )

        return F.pandas_udf(run, "rule string, verdict string")


def judged(
    pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id",
    default: str = "allow",
) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    array = DigestArray(pages.sparkSession, rules)
    host, path = host_and_path(named(url))
    parts = pages.select(named(key).alias("page_id"), host.alias("host"), path.alias("path"))
    keys = parts.withColumn("keys", candidates(
        F.col("host"), F.col("path"), array.lengths, array.labels))
    hit = keys.select(
        "page_id", "host", "path",
        array.probe()("keys", F.transform("keys", lambda x: F.xxhash64(x))).alias("hit"),
    )
    return hit.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"),
    )


def by_join(
    pages: DataFrame, rules: DataFrame, lengths: Sequence[int], url: str = "url",
    key: str = "page_id", default: str = "allow", labels: int = 8,
) -> DataFrame:
    """The same for a table of rules of any size, one exploded key each.

    ``lengths`` are the lengths of the rules' paths, ``labels`` the most labels of a rule's host.
    """
    host, path = host_and_path(named(url))
    parts = pages.select(
        named(key).alias("page_id"), host.alias("host"), path.alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    listed = rules.groupBy(F.concat("host", "path").alias("rule")).agg(
        F.min("verdict").alias("verdict")
    )
    hits = parts.select("row", F.explode(candidates(F.col("host"), F.col("path"), lengths, labels))
                        .alias("rule")).join(listed, "rule")
    order = Window.partitionBy("row").orderBy(
        F.length("rule").desc(), F.length(F.substring_index("rule", "/", 1)).desc()
    )
    best = hits.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return parts.join(best.select("row", "rule", "verdict"), "row", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
