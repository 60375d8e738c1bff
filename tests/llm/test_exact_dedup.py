from collections import defaultdict
from hashlib import sha256

from kontor.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    found = []
    for text, keys in groups.items():
        last = max(keys, key=lambda k: (k is not None, k or 0))
        shown = sorted(keys, key=lambda k: (k is not None, k or 0), reverse=True)
        for place, key in enumerate(shown):
            found.append((key, last, len(keys), place == 0, sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


def shown(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_groups_as_by_hand(documents, odd):
    for docs in (documents, odd):
        rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
        assert shown(exact_dedup.exact_groups(docs)) == expected(rows)


def test_one_row_of_each_text_stays(documents, odd):
    for docs in (documents, odd):
        left = exact_dedup.drop_exact(docs)
        assert left.columns == docs.columns
        rows = left.collect()
        want = {(r[4], r[0]) for r in expected([(r["doc_id"], r["text"]) for r in docs.collect()]) if r[3]}
        got = [(sha256((r["text"] or "").encode()).hexdigest(), r["doc_id"]) for r in rows]
        assert len(got) == len(want) and set(got) == want


def test_a_full_filter_changes_nothing(documents, monkeypatch):
    before = shown(exact_dedup.exact_groups(documents))
    monkeypatch.setattr(exact_dedup, "LEAST_BITS", 64)
    monkeypatch.setattr(exact_dedup, "MOST_BITS", 64)
    assert shown(exact_dedup.exact_groups(documents)) == before


def test_nothing(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.drop_exact(nothing).count() == 0
