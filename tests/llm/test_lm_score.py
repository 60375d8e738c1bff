import math
import re
from collections import Counter

import pytest

from kontor.llm import lm_score


def by_hand(rows, order, backoff):
    docs = []
    for key, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = Counter(tuple(words[i - n:i]) for n in range(1, order + 1) for i in range(n, len(words) + 1))
        docs.append((key, words, grams))
    all_grams = Counter()
    for _, _, grams in docs:
        all_grams.update(grams)
    corpus = sum(len(words) for _, words, _ in docs)
    found = []
    for key, words, grams in docs:
        total, unseen = 0.0, 0
        for i in range(1, len(words) + 1):
            longest = min(order, i)
            value = backoff**longest / max(1, corpus - len(words))
            for m in range(longest, 0, -1):
                gram = tuple(words[i - m:i])
                count = all_grams[gram] - grams[gram]
                if count:
                    under = all_grams[gram[:-1]] - grams[gram[:-1]] if m > 1 else max(1, corpus - len(words))
                    value = backoff**(longest - m) * count / under
                    break
            else:
                unseen += 1
            total += math.log(value)
        found.append((key, len(words), total, unseen))
    return found


@pytest.mark.parametrize("order,size", [(2, 16 << 20), (3, 20_000), (1, 1)])
def test_as_by_hand(spark, documents, odd, tmp_path, order, size):
    odd.write.parquet(str(tmp_path / "odd"))
    for docs in (spark.read.parquet("/root/testdata/sf0.001/documents.parquet"),
                 spark.read.parquet(str(tmp_path / "odd"))):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = sorted(by_hand(rows, order, 0.4), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        got = sorted(lm_score.scores(docs, order=order, block_bytes=size).collect(),
                     key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["words"]))
        assert [(r["doc_id"], r["words"], r["unseen"]) for r in got] == [(k, n, u) for k, n, _, u in want]
        for one, (_, count, score, _) in zip(got, want, strict=True):
            assert one["score"] == pytest.approx(score, abs=1e-5)
            assert one["mean"] == pytest.approx(score / count if count else 0.0, abs=1e-5)


def test_nothing(nothing):
    assert lm_score.scores(nothing).count() == 0
