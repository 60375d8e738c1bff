"""Repair of conversations against a search over all edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from kontor.llm import conversations as op
from kontor.llm import queries

SPACE = " \t\n\x0b\x0c\r"


def shown(value):
    return " " if value is None else str(value)


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range((1, 2)[kind == 3] if kind else 0):
            yield conv, turn, role, text


def accepted(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def cheapest(rows):
    """(cost, audit, lines) by Dijkstra over (row, roles so far): every prefix on its own."""
    heap, done = [(0, "", 0, "", ())], {}
    best = None
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            return best
        if at == len(rows) and accepted({"": "", "s": "s", "u": "u", "a": "ua"}[state]):
            found = (cost, audit, lines)
            best = found if best is None or found[:2] < best[:2] else best
        if done.setdefault((at, state, cost), audit) < audit:
            continue
        done[at, state, cost] = audit
        want = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", at, want[0], (*lines, want + ":")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, lines))
            if fault in ("blank", "duplicate"):
                continue
            late = 3 * (fault == "truncated")
            follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            if role[:1] and role[0] in follows:
                heapq.heappush(heap, (cost + late, audit + "K", at + 1, role[0], (*lines, f"{role}:{text}")))
            heapq.heappush(heap, (cost + late + 3, audit + "R", at + 1, want[0], (*lines, f"{want}:{text}")))
    return best


def expected(rows):
    found = {}
    held = {}
    for row in rows:
        held.setdefault(row[0], [])
    for row in damaged(rows):
        held[row[0]].append(row[1:])
    for conv, own in held.items():
        mark = {r: hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).hexdigest() for r in own}
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), mark[r]))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            last = text.rstrip(SPACE)[-1:]
            fault = ("blank" if not last else "duplicate" if (role, text) in seen
                     else None if last in ".!?" else "truncated")
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        turns = {turn for turn, _, _ in own if turn is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(marked)
        found[conv] = (conv, gaps, *counts.values(), illegal, cost, audit,
                       hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def compare(df, rows):
    found = [tuple(row) for row in df.select(*COLUMNS).collect()]
    wanted = expected(rows)
    assert len(found) == len(wanted)
    for row in found:
        assert row == wanted[row[0]]


def test_given_conversations(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    compare(queries.QUERIES["op11_conversation_repair"](spark, folder), rows)


def made_up(seed, convs, turns):
    draw = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(draw.randint(1, turns)):
            for _ in range(draw.choice([1, 1, 1, 2])):
                rows.append((
                    draw.choice([conv, conv, conv, None]) if seed % 2 else conv,
                    draw.choice([turn, turn, turn, None, turn + 3]),
                    draw.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Ümlaut"]),
                    draw.choice(["Yes.", "no", "", None, "  \n", "A a!", "é? ", "what", "cut off,", "b\nc."]),
                ))
    return rows


@pytest.mark.parametrize("seed, convs, turns", [(2, 60, 9), (4, 3, 50), (1, 12, 20)])
def test_odd_conversations(spark, seed, convs, turns):
    """Nulls, repeated rows, long conversations that straddle ranges, extra columns."""
    rows = made_up(seed, convs, turns)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for name in ("conv", "mark", "copies", "part", "audit", "a.b"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    compare(op.repaired(df), rows)


def test_no_conversation(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert op.repaired(empty).count() == 0


def test_one_conversation_spreads_over_tasks(spark):
    rows = [(1, n, "user" if n % 2 else "assistant", f"text {n}.") for n in range(250)] + [(2, 1, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {row["conv_id"]: row for row in op.repaired(df).collect()}
    again = expected(rows)
    assert tuple(found[1][name] for name in COLUMNS) == again[1]


def test_grammar_gives_the_words_back():
    draw = np.random.default_rng(5)
    words = [bytes(draw.integers(0, 3, draw.integers(0, 30)).astype(np.uint8)) for _ in range(200)]
    words += [bytes([1]) * 9, b"", bytes([0]) * 8]
    signs = np.frombuffer(b"\xff".join([b"", *words, b""]), dtype=np.int8).astype(np.int32)
    short, rules = op.repair_rules(signs)
    assert rules and len(short) < len(signs) / 2

    def spelled(symbol):
        if symbol <= op.GONE:
            return [symbol]
        left, right = rules[symbol - op.GONE - 1]
        return spelled(left) + spelled(right)

    assert [x for s in short.tolist() for x in spelled(s)] == signs.tolist()
    plain = [op.matrix_of([op.sign_matrix(s) for s in word]) for word in words]
    for one, two in zip(op.matrices(words), plain):
        assert op.whole_way(one) == op.whole_way(two)
