"""The pipeline, stage by stage, against plain code over the same rows."""

from collections import Counter, defaultdict

from test_mixing_sharding import targets, words
from test_simhash import by_hand, groups_by_hand
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kontor.llm import lang_id, queries
from kontor.session import stored

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_stage(spark, documents):
    given = documents.collect()
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL))
        kept[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS

    lettered = [r for r in given if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(kept["language_id"].collect()) == sorted(lettered)

    last = {}
    for row in lettered:
        last[row["text"]] = max(row["doc_id"], last.get(row["text"], -1))
    unique = [r for r in lettered if last[r["text"]] == r["doc_id"]]
    assert sorted(kept["exact_dedup"].collect()) == sorted(unique)

    prints = [(r["doc_id"], by_hand(r["text"])) for r in unique]
    first = set(groups_by_hand(set(prints)).values())
    apart = [r for r in unique if r["doc_id"] in first]
    assert sorted(kept["near_dedup"].collect()) == sorted(apart)

    sizes = Counter()
    for row in apart:
        sizes[row["source"]] += words(row["text"])
    want, got, longest = targets(sizes), Counter(), Counter()
    mixed = kept["mixing"].collect()
    for row in mixed:
        got[row["source"]] += words(row["text"])
    for row in apart:
        longest[row["source"]] = max(longest[row["source"]], words(row["text"]))
    assert all(abs(got[s] - want[s]) <= longest[s] + 1 for s in sizes)
    assert set(mixed) <= set(apart) and max(Counter(mixed).values()) <= 3

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    lengths = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in apart}
    packed, fill = Counter(), defaultdict(int)
    for row in kept["packing"].collect():
        packed[row["doc_id"]] += row["length"]
        fill[row["sequence_id"]] += row["length"]
    assert packed == Counter({k: lengths[k] * n for k, n in Counter(r["doc_id"] for r in mixed).items()})
    assert all(n <= 4096 and n & (n - 1) == 0 for n in fill.values())


def test_nothing_to_learn_from(spark, documents, odd):
    for docs in (documents.withColumn("lang", F.lit(None).cast("string")),
                 odd.select(*COLUMNS).withColumn("lang", F.lit(None).cast("string")),
                 documents.withColumn("lang", F.when(lang_id.held_out(F.col("doc_id")), F.col("lang")))):
        left = lang_id.keep_identified(docs)
        key = lambda r: [(x is not None, x) for x in r]
        want = [r for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
        assert want and sorted(left.collect(), key=key) == sorted(want, key=key)


def test_odd_rows_and_none_pass_all_stages(spark, odd, nothing):
    for docs in (odd.select(*COLUMNS), nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SMALL))
    assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0
