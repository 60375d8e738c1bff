import re
import zlib
from collections import Counter, defaultdict

from kontor.llm import mixing, sharding


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Targets by repeated sharing, as the rule is told."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + at % 3 for at, s in enumerate(names)}
    fixed, free = {}, set(names)
    while free:
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}
        free -= above
    return fixed


def test_targets_and_taken_words(documents, odd):
    for docs in (documents, odd):
        rows = mixing.mix(docs).collect()
        sizes = Counter()
        for row in docs.collect():
            sizes[row["source"]] += words(row["text"])
        want = targets(sizes)
        taken, longest = Counter(), Counter()
        assert len(rows) == docs.count()
        for row in rows:
            s = row["source"]
            taken[s] += row["taken"]
            longest[s] = max(longest[s], row["size"])
            assert row["source_size"] == sizes[s] and abs(row["target"] - want[s]) < 1e-6 * (1 + want[s])
            assert 0 <= row["taken"] <= 3 * row["size"] and row["taken"] == row["copies"] * row["size"]
        for s in sizes:
            assert abs(taken[s] - want[s]) <= longest[s] + 1


def test_systematic_within_a_source(documents):
    """Copies differ by one at most inside a source, and reruns agree."""
    found = defaultdict(set)
    first = mixing.mix(documents).collect()
    for row in first:
        found[row["source"]].add(row["copies"])
    assert all(max(x) - min(x) <= 1 for x in found.values())
    again = mixing.mix(documents.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in first) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_mixed_documents(documents, odd, nothing):
    for docs in (documents, odd):
        out = mixing.mixed(docs)
        assert out.columns == docs.columns
        want = Counter()
        for row in mixing.mix(docs).collect():
            want[row["doc_id"], row["source"]] += row["copies"]
        got = Counter((row["doc_id"], row["source"]) for row in out.collect())
        assert got == +want
    assert mixing.mixed(nothing).count() == mixing.mix(nothing).count() == 0


def test_shards(documents, odd, nothing):
    for docs in (documents, odd):
        rows = sharding.shards(docs, sharding.regular_tree(16), sharding.regular_tree(17)).collect()
        texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
        assert sorted([(r["doc_id"], r["size"], r["text_crc32"]) for r in rows], key=str) == sorted(
            [(k, len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts], key=str)
        slots = defaultdict(list)
        for row in rows:
            slots[row["shard"]].append(row["slot"])
            assert row["law"] == "key" and 0 <= row["shard"] < 16
            assert row["grown_shard"] in (row["shard"], 16)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        by_key = defaultdict(set)
        for row in rows:
            by_key[row["doc_id"]].add(row["shard"])
        assert all(len(x) == 1 for x in by_key.values())
    assert sharding.shards(nothing, sharding.regular_tree(16)).count() == 0


def test_shares_follow_weights(spark):
    tree = [sharding.Leaf(0, 0, 0, 1.0), sharding.Leaf(0, 0, 1, 3.0), sharding.Leaf(1, 1, 2, 4.0)]
    heavier = [*tree[:2], sharding.Leaf(1, 1, 2, 8.0)]
    keys = spark.range(8000)
    both = keys.select(
        sharding.shard_of(sharding.text_key(keys.id), tree).alias("a"),
        sharding.shard_of(sharding.text_key(keys.id), heavier).alias("b"),
    ).collect()
    share = Counter(r["a"] for r in both)
    assert abs(share[0] - 1000) < 150 and abs(share[1] - 3000) < 200 and abs(share[2] - 4000) < 200
    assert all(r["b"] in (r["a"], 2) for r in both)
