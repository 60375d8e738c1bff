import random
import re

import xxhash
from pyspark.sql import functions as F

from kontor.llm import components, simhash


def by_hand(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows):
    """Of (id, fingerprint) the smallest id in reach."""
    left, found = list(rows), {}
    while left:
        reached, frontier = [], [left.pop()]
        while frontier:
            reached += frontier
            near = [r for r in left if any((r[1] ^ f[1]).bit_count() <= 4 for f in frontier)]
            left = [r for r in left if r not in near]
            frontier = near
        ids = [r[0] for r in reached if r[0] is not None]
        for row in reached:
            found[row] = min(ids) if ids else None
    return found


def test_as_by_hand(documents, odd):
    for docs in (documents, odd):
        rows = [(row["doc_id"], by_hand(row["text"])) for row in docs.collect()]
        want = groups_by_hand(set(rows))
        got = simhash.near_groups(docs).collect()
        assert sorted(((r[0], int(r[1], 16)) for r in got), key=str) == sorted(rows, key=str)
        assert all(len(r[1]) == 16 and want[r[0], int(r[1], 16)] == r[2] for r in got)


def test_text_in_pieces(monkeypatch):
    text = "Some Words, of a longer\ttext \n with é and more words  than a piece holds"
    for size in (1, 5, 17, 1000):
        monkeypatch.setattr(simhash, "_PIECE", size)
        assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == by_hand(text)


def families(spark, seed):
    draw = random.Random(seed)
    prints = set()
    for _ in range(20):
        value = draw.getrandbits(64)
        for _ in range(30):
            prints.add(value)
            for _ in range(draw.randint(1, 5)):
                value ^= 1 << draw.randrange(64)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    return spark.createDataFrame([(p, at) for at, p in enumerate(signed)], "print bigint, first bigint")


def test_no_link_is_lost_whatever_the_limit(spark):
    prints = families(spark, 1)
    rows = [(p, p & (1 << 64) - 1) for p, _ in prints.collect()]
    want = groups_by_hand(set(rows))
    for limit in (2, 8, 4096):
        links = simhash.links(prints, limit=limit)
        roots = {r["node"]: r["root"] for r in components.components(links).collect()}
        assert {p: roots.get(p, p) for p, _ in rows} == {p: want[p, q] for p, q in rows}


def test_components_of_a_chain(spark):
    chain = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = components.components(chain).collect()
    assert len(rows) == 500 and {r["root"] for r in rows} == {0}


def test_one_of_each_group_stays(documents, odd, nothing):
    rows = [(row["doc_id"], by_hand(row["text"])) for row in documents.collect()]
    want = groups_by_hand(set(rows))
    left = simhash.drop_near(documents)
    assert left.columns == documents.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values()))
    assert simhash.drop_near(odd).columns == odd.columns
    assert simhash.drop_near(nothing).count() == simhash.near_groups(nothing).count() == 0
