"""Repairing the structure of conversations at least cost.

The rows of a conversation become a word over a few signs: what a row's role is, and
whether it must go or is truncated.  Reading such a sign is a small min-plus matrix over the
states of the grammar ``(s?(ua)+)?``: entry (i, j) is the cheapest way from state i to
state j, its cost and its audit, the edits' initials.  The signs of many conversations are
compressed by Re-Pair: the most frequent pair of symbols becomes a rule until no pair is
frequent.  A rule's matrix is the product of its two symbols' matrices, so it is worked out
once, bottom-up, and shared by all conversations that hold it.

Audits are ropes: a product refers to its halves, and text is only made to break a tie, or
at the end.  Of equally cheap audits neither begins another, as a longer one would have
further insertions, so the least half makes the least whole.

* Rows are ordered by turn, nulls first, then by role and the SHA-256 of role and text.  Equal rows
  are interchangeable and travel as one with a count.
* Signs, not texts, are sorted, by ranges of (conversation, turn); a conversation of any size
  spreads over tasks, each giving the matrix of its part.  Texts are shuffled once, and
  read in order, for the checksum: one conversation's checksum is one stream
  by definition, and holds one batch at a time.
* A null role or text is one blank, and so are null ids and turns in the key of the damage.  Rows
  without conversation id form one conversation.  An empty table gives an empty result.
* What repairs a conversation follows from the audit: an inserted or changed role is the one
  the grammar wants next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import named, tasks
from kontor.session import stored

#: Signs that are compressed together, and how often a pair must occur to become a rule.
TOGETHER = 1 << 17
LEAST = 4
RULES = 4096

# States of the grammar: at the start, after s, after u, after a.  All but 1 and 2 may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
#: State that follows by each role initial.
NEXT = {("s", START): AFTER_S, **{("u", i): AFTER_U for i in (START, AFTER_S, AFTER_A)},
        ("a", AFTER_U): AFTER_A}
#: The role an inserted or changed row gets in each state.
WANTED = {START: "user", AFTER_S: "user", AFTER_U: "assistant", AFTER_A: "user"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Signs: role (s, u, a, other) times whole or truncated; then rows that must go.
ROLES = "sua?"
GONE = 2 * len(ROLES)

Rope = str | tuple
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def text_of(rope: Rope) -> str:
    """The text of a rope, without recursion."""
    parts, left = [], [rope]
    while left:
        now = left.pop()
        if isinstance(now, str):
            parts.append(now)
        else:
            left += (now[1], now[0])
    return "".join(parts)


def better(one: Entry, two: Entry) -> Entry:
    """The cheaper of two ways; of equally cheap ones that of the lesser audit."""
    if one is None or two is None:
        return two if one is None else one
    if one[0] != two[0]:
        return one if one[0] < two[0] else two
    return min(one, two, key=lambda way: text_of(way[1]))


def product(left: Matrix, right: Matrix) -> Matrix:
    out = []
    for row in left:
        line = []
        for j in STATES:
            best = None
            for k in STATES:
                if row[k] is not None and (then := right[k][j]) is not None:
                    # A dearer way needs no rope.
                    cost = row[k][0] + then[0]
                    if best is None or cost <= best[0]:
                        best = better(best, (cost, (row[k][1], then[1])))
            line.append(best)
        out.append(line)
    return out


def insertions() -> Matrix:
    """Any number of insertions; more than three come back to a state at a cost."""
    out: Matrix = [[(0, "") if i == j else None for j in STATES] for i in STATES]
    for i in STATES:
        state = i
        for count in (1, 2, 3):
            state = NEXT[WANTED[state][0], state]
            out[i][state] = better(out[i][state], (INSERT * count, "I" * count))
    return out


def sign_matrix(sign: int) -> Matrix:
    """Insertions, and then a row of this sign kept, changed or deleted."""
    row: Matrix = [[None for _ in STATES] for _ in STATES]
    for i in STATES:
        row[i][i] = (DELETE, "D")
        if sign == GONE:
            continue
        late = TRUNCATED * (sign % 2)
        kept = NEXT.get((ROLES[sign // 2], i))
        if kept is not None:
            row[i][kept] = better(row[i][kept], (late, "K"))
        changed = NEXT[WANTED[i][0], i]
        row[i][changed] = better(row[i][changed], (REROLE + late, "R"))
    return product(insertions(), row)


def matrix_of(matrices: list[Matrix]) -> Matrix:
    """The product of any number of matrices, in halves."""
    if not matrices:
        return [[(0, "") if i == j else None for j in STATES] for i in STATES]
    while len(matrices) > 1:
        paired = [product(a, b) for a, b in zip(matrices[::2], matrices[1::2])]
        matrices = paired + matrices[len(matrices) & ~1:]
    return matrices[0]


def whole_way(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit from the start to an end of the grammar, last insertions included."""
    done = product([matrix[START]], insertions())[0]
    cost, rope = better(done[START], done[AFTER_A])
    return cost, text_of(rope)


def repair_rules(signs: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Re-Pair: symbols in place of ``signs``, and the pair that each rule stands for.

    -1 parts words and is in no rule.  Symbols from ``GONE + 1`` on are rules.
    """
    rules: list[tuple[int, int]] = []
    while len(rules) < RULES and len(signs) > 1:
        codes = signs[:-1].astype(np.int64) << 32 | signs[1:].astype(np.int64)
        held = (signs[:-1] >= 0) & (signs[1:] >= 0)
        pairs, counts = np.unique(codes[held], return_counts=True)
        if not len(counts) or counts.max() < least:
            break
        pair = pairs[counts.argmax()]
        at = np.flatnonzero(held & (codes == pair))
        if pair >> 32 == pair & 0xFFFFFFFF:  # of a run every second place
            run = np.concatenate([[0], np.flatnonzero(np.diff(at) > 1) + 1])
            since = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[since % 2 == 0]
        signs = signs.copy()
        signs[at] = GONE + 1 + len(rules)
        signs = np.delete(signs, at + 1)
        rules.append((int(pair >> 32), int(pair & 0xFFFFFFFF)))
    return signs, rules


def matrices(words: list[bytes]) -> list[Matrix]:
    """The matrix of every word of signs, by one grammar."""
    signs = np.frombuffer(b"\xff".join([b"", *words, b""]), dtype=np.int8).astype(np.int32)
    signs, rules = repair_rules(signs)
    known = [sign_matrix(sign) for sign in range(GONE + 1)]
    for left, right in rules:
        known.append(product(known[left], known[right]))
    found: list[Matrix] = []
    again: dict[bytes, Matrix] = {}
    bounds = np.flatnonzero(signs == -1)
    for first, last in zip(bounds, bounds[1:]):
        part = signs[first + 1:last]
        key = part.tobytes()
        if key not in again:
            again[key] = matrix_of([known[symbol] for symbol in part.tolist()])
        found.append(again[key])
    return found


# Damage and faults, as columns.

def _shown(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, copies (0: dropped) of every row, after damage by a hash of its key."""
    kind = F.crc32(F.concat(_shown(named(conv)), F.lit(":"), _shown(named(turn)))) % 20
    shown = _shown(named(text))
    return rows.select(
        named(conv).cast("bigint").alias("conv"), named(turn).cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(_shown(named(role))).alias("role"),
        F.when((kind == 0) | (kind == 1), F.lit(""))
        .when(kind == 2, F.regexp_replace(shown, r"[.!?]", "")).otherwise(shown).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def signed(rows: DataFrame) -> DataFrame:
    """conv, turn, role, mark, sign, blank, copies, seen of equal rows taken together.

    ``sign`` is what the first of these rows is if no equal role and text is before it; ``seen``
    says that one is, in an earlier turn.
    """
    tail = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    place = F.position(F.substring("role", 1, 1), F.lit(ROLES[:3]))
    kind = F.when((F.length("role") > 0) & (place > 0), place - 1).otherwise(len(ROLES) - 1)
    groups = rows.filter(F.col("copies") > 0).select(
        "conv", "turn", "role", _mark().alias("mark"), "copies",
        (tail == "").alias("blank"),
        F.when(tail == "", GONE).otherwise(
            2 * kind + F.when(tail.isin(".", "!", "?"), 0).otherwise(1)
        ).cast("int").alias("sign"),
    ).groupBy("conv", "turn", "role", "mark", "blank", "sign").agg(F.sum("copies").alias("copies"))
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    first = groups.groupBy("conv", "mark").agg(F.min(order).alias("first")).select(
        F.col("conv").alias("of"), F.col("mark").alias("marked"), "first"
    )
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("marked"))
    return groups.join(first, same).select(
        *groups.columns, (order != F.col("first")).alias("seen")
    )


def _mark() -> Column:
    return F.sha2(F.concat("role", F.lit("\0"), "text"), 256)


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


_COUNTS = ["rows", "blank", "duplicate", "truncated", "illegal"]
_PART = (
    "conv bigint, part int, edge boolean, rows bigint, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, "
    "turns bigint, costs array<bigint>, audits array<string>"
)


class Part:
    """A conversation, or what one task has of it, in order."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.signs = conv, bytearray()
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first = self.last = self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, sign: int, blank: bool, copies: int, seen: bool) -> None:
        fresh = not (seen or blank)
        self.signs += bytes([sign if fresh else GONE]) + bytes([GONE]) * (copies - 1)
        self.counts["rows"] += copies
        self.counts["blank" if blank else "duplicate"] += copies - fresh
        self.counts["truncated"] += fresh and sign % 2
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.counts["illegal"] += self.last + initial not in ("su", "ua", "au")
        self.counts["illegal"] += copies - 1  # no initial may follow itself
        self.last = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1


def _records(parts: list[tuple[Part, bool]], part_id: int) -> pa.RecordBatch:
    rows = []
    for (part, edge), matrix in zip(parts, matrices([bytes(part.signs) for part, _ in parts])):
        if edge:
            ways = [way for row in matrix for way in row]
        else:
            ways = [whole_way(matrix)]
        rows.append({
            "conv": part.conv, "part": part_id, "edge": edge, **part.counts,
            "first": part.first, "last": part.last, "low": part.low, "high": part.high,
            "turns": part.turns, "costs": [None if way is None else way[0] for way in ways],
            "audits": [None if way is None else text_of(way[1]) for way in ways],
        })
    return pa.RecordBatch.from_pylist(rows, schema=_schema())


def _schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(),
             "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in
                      (field.split(" ") for field in _PART.split(", "))])


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one sorted range; its first and last may go on in others."""
    held: list[tuple[Part, bool]] = []
    now, size, part_id, first = None, 0, -1, True
    names = ("conv", "turn", "role", "sign", "blank", "copies", "seen", "part")
    for batch in batches:
        for conv, *row, part_id in zip(*[batch[name].to_pylist() for name in names], strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    held.append((now, first))
                    size, first = size + len(now.signs), False
                    if size > TOGETHER:
                        yield _records(held, part_id)
                        held, size = [], 0
                now = Part(conv)
            now.add(*row)
    if now is not None:
        yield _records([*held, (now, True)], part_id)


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record of each conversation whose parts follow one another."""
    now: dict | None = None
    for batch in batches:
        for row in batch.to_pylist():
            ways = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"])]
            if now is not None and row["conv"] == now["conv"]:
                matrix = [ways[4 * i:4 * i + 4] for i in STATES]
                now["way"] = product(now["way"], matrix)
                for name in _COUNTS:
                    now[name] += row[name]
                now["illegal"] += now["last"] + row["first"] not in ("su", "ua", "au")
                now["turns"] += row["turns"] - (
                    row["low"] is not None and row["low"] == now["high"])
                now["low"] = row["low"] if now["low"] is None else now["low"]
                now["high"] = now["high"] if row["high"] is None else row["high"]
                now["last"] = row["last"]
            else:
                if now is not None:
                    yield _finished(now)
                now = row | {"way": [ways[:4]]}
    if now is not None:
        yield _finished(now)


def _finished(row: dict) -> pa.RecordBatch:
    cost, audit = whole_way([row.pop("way")[START]])
    return pa.RecordBatch.from_pylist(
        [row | {"edge": False, "costs": [cost], "audits": [audit]}], schema=_schema())


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksums of repaired conversations: of each its audit, then its rows in order."""
    names = ("conv", "audit", "role", "text", "copies")
    conv, audit, at, state, begun, check, done = None, "", 0, START, False, None, []

    def put(role: str, text: str) -> None:
        nonlocal state, begun
        check.update(f"{chr(10) * begun}{role}:{text}".encode())
        state, begun = NEXT[role[:1], state], True

    def inserted() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            put(WANTED[state], "")
            at += 1

    def record() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done])],
            ["conv", "sha"])

    for batch in batches:
        for key, found, role, text, copies in zip(*[batch[n].to_pylist() for n in names], strict=True):
            if check is None or key != conv:
                if check is not None:
                    inserted()
                    done.append((conv, check.hexdigest()))
                conv, audit, at, state, begun = key, "", 0, START, False
                check = hashlib.sha256()
            if found is not None:
                audit = found
                continue
            for _ in range(copies):
                inserted()
                edit, at = audit[at], at + 1
                if edit != "D":
                    put(role if edit == "K" else WANTED[state], text)
        if len(done) > 1000:
            yield record()
            done = []
    if check is not None:
        inserted()
        done.append((conv, check.hexdigest()))
    if done:
        yield record()


def repaired(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256
    of every conversation, after damage."""
    damage = damaged(rows, conv, turn, role, text)
    count = tasks(rows)
    order = _order()
    signs = stored(signed(damage))
    parts = stored(
        signs.repartitionByRange(count, *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).mapInArrow(_parts, _PART)
    )
    # Two conversations of each range, as many as there are shuffle partitions, at most.
    edges = parts.filter("edge").repartition(count, "conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), "part"
    ).mapInArrow(_joined, _PART)
    answers = stored(parts.filter("NOT edge").unionByName(edges).select(
        "conv",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        *_COUNTS[1:], F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"),
    ))
    lines = damage.select(
        "conv", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", "copies",
        _mark().alias("mark"),
    ).unionByName(answers.select("conv", "audit"), allowMissingColumns=True)
    checks = lines.repartition(count, "conv").sortWithinPartitions(
        order[0], F.col("audit").isNull(), *order[1:]
    ).mapInArrow(_repaired, "conv bigint, sha string")
    known = answers.withColumnRenamed("conv", "of")
    zero = F.lit(0).cast("bigint")
    return checks.join(known, F.col("conv").eqNullSafe(F.col("of")), "left").select(
        F.col("conv").alias("conv_id"),
        *[F.coalesce(name, zero).alias(name) for name in ("gaps", *_COUNTS[1:], "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.col("sha").alias("repaired_sha256"),
    )
