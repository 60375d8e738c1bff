import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kontor.llm import knn, lang_id, packing, queries, tokens

ROWS = "vec_id bigint, embedding array<float>, label int"


def parse(text, sample):
    """Phrases by the plain rule, in blocks."""
    count = 0
    for begin in range(0, len(text), lang_id.BLOCK):
        block, at = text[begin:begin + lang_id.BLOCK], 0
        while at < len(block):
            size = 1
            while at + size < len(block) and block[at:at + size + 1] in sample:
                size += 1
            at, count = at + size, count + 1
    return count


def test_phrases_as_by_hand():
    samples = {"a": ["the cat sat on the mat and the hat"], "b": ["der hund und die katze, über alles"]}
    model = lang_id.Model(samples)
    plains = {k: lang_id.plain(v[0]) for k, v in samples.items()}
    texts = ["The cat and THE dog", "", None, "über die hunde 12 und", "xyz жук", " 1 ", "the " * 3000]
    total, lengths = model.phrases(texts)
    for row, text in enumerate(texts):
        shown = lang_id.plain(text or "")
        assert lengths[row] == len(shown)
        for lane, lang in enumerate(model.languages):
            assert total[row, lane] == parse(shown, plains[lang]), (text, lang)
    found = model.predict(texts)
    assert found["lang_pred"].tolist()[:4] == ["a", "und", "und", "b"]
    assert found["score"].between(0, 1).all()


def drawn(draw, first, letters, words=60):
    """A text of words of up to four letters, of a fixed few hundred."""
    known = random.Random(first * 1000 + letters)
    stock = ["".join(chr(first + known.randrange(letters)) for _ in range(known.randint(1, 4))) for _ in range(300)]
    return " ".join(draw.choice(stock) for _ in range(words))


#: Two languages of one script with many letters, and four more scripts: first letter, letters.
SCRIPTS = {"zh": (0x4E00, 900), "ja": (0x4E00, 901), "ko": (0xAC00, 700), "ru": (0x430, 32),
           "he": (0x5D0, 27), "en": (0x61, 26), "xx": (0x20000, 300)}


@pytest.mark.parametrize("most", [0, lang_id.PLAIN, 1 << 28])
def test_letters_of_many_scripts(monkeypatch, most):
    monkeypatch.setattr(lang_id, "PLAIN", most)
    draw = random.Random(5)
    samples = {lang: [drawn(draw, *script, 200)] * (40 if lang in ("en", "ru", "he") else 1)
               for lang, script in SCRIPTS.items()}
    model = lang_id.Model(samples)
    plains = {lang: " ".join(map(lang_id.plain, texts)) for lang, texts in sorted(samples.items())}
    texts = [drawn(draw, *script, 15) for script in SCRIPTS.values()] + ["\u4e01\U0001f600\u10a0 \u4e02", ""]
    total, lengths = model.phrases(texts)
    for row, text in enumerate(texts):
        assert lengths[row] == len(lang_id.plain(text))
        for lane, lang in enumerate(model.languages):
            assert total[row, lane] == parse(lang_id.plain(text), plains[lang]), (text, lang)
    assert model.predict(texts)["lang_pred"].tolist()[:len(SCRIPTS)] == list(SCRIPTS)


def test_more_labels_than_languages(spark, monkeypatch):
    draw = random.Random(6)
    labels = {f"l{n:02}": (0x4E00 + 20 * n, 30) for n in range(3, 23)}
    rows = [(lang, drawn(draw, *script)) for lang, script in labels.items() for _ in range(90)]
    rows += [(f"stray {n}", drawn(draw, 0xAC00, 50, 5)) for n in range(5)]
    docs = spark.createDataFrame([(n, text, lang) for n, (lang, text) in enumerate(rows)],
                                 "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in lang_id.identified(docs).collect()}
    assert len(found) == len(rows)
    pairs = [(found[n], lang) for n, (lang, _) in enumerate(rows[:1800])]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.97
    sample = lang_id.training_sample(docs, "text", "lang")
    assert {lang for lang, _ in sample} == {lang for lang, _ in rows}
    assert len(sample) <= lang_id.LANGUAGES * lang_id.ROWS
    monkeypatch.setattr(lang_id, "LANGUAGES", 2)
    short = lang_id.training_sample(docs, "text", "lang", rows=2, chars=100)
    assert {lang for lang, _ in short} == {lang for lang, _ in rows} and len(short) == 25
    assert max(len(text) for _, text in short) == 100 * 4 // 25
    monkeypatch.setattr(lang_id, "HELD", 30)
    monkeypatch.setattr(lang_id, "LANES", 3)
    again = lang_id.fit(docs.filter(~lang_id.held_out(F.col("doc_id"))))
    assert again.predict([rows[0][1], "", rows[90][1]])["lang_pred"].tolist() == ["l03", "und", "l04"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lang_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    tested = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in tested} == {
        r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.97


def test_query_as_by_hand(spark, documents, tmp_path):
    """Every row of the query, by the plain rule over the samples it learns from."""
    rows = documents.filter("length(text) < 1500").unionByName(
        spark.createDataFrame([(-1, None, "en"), (-2, "", "de"), (-3, "12 + 3", None), (None, "the", "en")],
                              "doc_id bigint, text string, lang string"), allowMissingColumns=True)
    rows.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    learned = docs.filter("crc32(coalesce(cast(doc_id as string), '')) % 3 <> 1")
    samples = defaultdict(list)
    for lang, text in lang_id.training_sample(learned, "text", "lang"):
        samples[lang].append(lang_id.plain(text))
    samples = {lang: " ".join(texts) for lang, texts in sorted(samples.items())}
    assert len(samples) == 4

    def judged(text):
        shown = lang_id.plain(text or "")
        if not shown.strip():
            return "und", 0.0
        bits = {lang: parse(shown, sample) * np.log2(len(sample) + 2) for lang, sample in samples.items()}
        first, second = sorted(bits.values())[:2]
        return min(bits, key=lambda lang: (bits[lang], lang)), 1 - first / second

    want = sorted(
        (row.doc_id or 0, zlib.crc32(str(row.doc_id).encode() if row.doc_id is not None else b"") % 3 == 1,
         *judged(row.text)) for row in docs.select("doc_id", "text").collect())
    got = sorted((row.doc_id or 0, row.held_out, row.lang_pred, row.score)
                 for row in queries.op2_language_id(spark, str(tmp_path)).collect())
    assert len(got) > 40 and [row[:3] for row in got] == [row[:3] for row in want]
    assert [row[3] for row in got] == pytest.approx([row[3] for row in want])


def test_odd_languages(odd, nothing):
    rows = {r["doc_id"]: r for r in lang_id.identified(odd).collect()}
    assert {k for k, r in rows.items() if r["lang_pred"] == "und"} == {3, 4, 5, 8}
    assert rows[3]["score"] == 0 and rows[10]["lang_pred"] == "de"
    left = lang_id.keep_identified(odd)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lang_id.identified(unlabelled).collect()} == {"und"}
    assert lang_id.identified(nothing).count() == 0


def best(rows, k=20, every=20):
    usable = {}
    kept = []
    for key, vector, _ in rows:
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        kept.append((key, [int(np.floor(64.0 * float(np.float32(x)))) for x in vector]))
    found = []
    for key, vector in kept:
        if key % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(vector, other)), name)
                        for name, other in kept if name != key)
        found += [(key, at + 1, name, -score) for at, (score, name) in enumerate(scores[:k])]
    return sorted(found), usable


def test_top_k_as_by_hand(spark):
    draw = random.Random(3)
    rows = [(n, [draw.gauss(0, 1) for _ in range(8)], 0) for n in range(300)]
    rows += [(n, [0.5] * 8, 0) for n in range(300, 420)]
    rows += [(420, None, 0), (421, [None] * 8, 0), (422, [float("nan")] * 8, 0), (423, [float("inf")] * 8, 0),
             (440, [1.0, 2.0], 0), (460, [], 0), (461, [0.1] * 8, 0), (461, [0.1] * 8, 0)]
    table = spark.createDataFrame(rows, ROWS)
    want, _ = best(rows)
    for pivots, size in ((4, 64), (32, 1024), (1, 10)):
        got = knn.top_k(table, queries.every("id", 20), pivots=pivots, slice_rows=size)
        assert sorted(map(tuple, got.collect())) == want


def test_few_and_large_vectors(spark):
    rows = [(n, [float(n), -1.0], 0) for n in range(5)]
    got = knn.top_k(spark.createDataFrame(rows, ROWS), queries.every("id", 20))
    assert sorted(map(tuple, got.collect())) == best(rows)[0]
    rows = [(n, [2.0**24 + n, 2.0**20], 0) for n in range(50)]
    got = knn.top_k(spark.createDataFrame(rows, ROWS), queries.every("id", 20))
    assert sorted(map(tuple, got.collect())) == best(rows)[0]
    assert knn.top_k(spark.createDataFrame([], ROWS), queries.every("id", 20)).count() == 0


def test_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = knn.top_k(table, queries.every("id", 20))
    assert sorted(map(tuple, got.collect())) == best([tuple(r) for r in table.collect()])[0]


@pytest.mark.parametrize("bits,dimensions", [(3, 2), (2, 3), (1, 4)])
def test_hilbert_curve_visits_neighbours(bits, dimensions):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = packing.hilbert_key(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_pieces_hold_every_id(documents, odd):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    for docs in (documents, odd):
        rows = packing.pack(docs, queries.tokenizer_path()).collect()
        by_sequence, by_doc = defaultdict(list), defaultdict(list)
        for r in rows:
            by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
            by_doc[r["doc_id"]].append(r)
            assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        sizes = []
        for pieces in by_sequence.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            sizes.append(at)
        assert all(n <= 4096 and n & (n - 1) == 0 for n in sizes)
        assert sorted(by_sequence) == list(range(len(by_sequence)))
        copies = defaultdict(list)
        for r in docs.collect():
            copies[r["doc_id"]].append(r["text"])
        for key, own in copies.items():
            ids = [*tokenizer.encode(own[0] or "", add_special_tokens=False).ids, 2]
            assert sum(r["length"] for r in by_doc[key]) == len(ids) * len(own)
            for r in by_doc[key]:
                want = np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4")
                assert r["ids"] == want.tobytes() and r["doc_tokens"] == len(ids)


def test_words_are_encoded_as_in_their_text():
    import pyarrow as pa

    encoder = tokens.Encoder(queries.tokenizer_path())
    assert encoder.by_word
    draw = random.Random(1)
    signs = "aAéÉßñÑœ.,'-1 \n\tİıŉǅǆªºΣς!<|>\u0301"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["It's ΣΑΣ ΟΔΟΣ, don't!", "a\u0301 \u0301x <|endoftext|>y\u00a0z", "", " \x0b\x1f\x85 q\u2003r ", "12 3.4..5 'Re"]
    ids, sizes = encoder.encode(pa.array(texts))
    want = [encoder.one(text) for text in texts]
    assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_nothing_to_pack(nothing):
    assert packing.pack(nothing, queries.tokenizer_path()).count() == 0
