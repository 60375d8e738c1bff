"""Personal data: patterns propose spans, checksums confirm, context adjusts.

Base kinds (email, ip, card, phone) are found leftmost and without overlap; a
match that fails its check is dropped and not tried again.  Further kinds add
spans and never replace base ones:

* ``iban``: a letter pair, two digits and 11 to 30 letters or digits, single
  blanks allowed, that leave 1 by mod 97 (ISO 7064).  Words that follow look alike, so
  every end of a word is tried: of those that hold, the one of the country's length
  counts, else the longest.  Every letter pair at the start of a word is tried, too.
* ``ssn``: ``ddd-dd-dddd``, only if words around it speak of such a number.

Every span has a score: the pattern's own, plus that of a checksum, plus that of
context words in the ``WINDOW`` characters before it.  Base spans are kept
whatever their score, others from ``THRESHOLD`` on.

Patterns are written so that a search stays linear in the text: runs are taken
whole (possessive), and a search starts only where a run starts.  This changes
no match.  Positions are in code points, end exclusive.  Null is the empty text
and has no spans; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import fresh, named, whole

BASE = ("email", "ip", "card", "phone")
WINDOW = 48
THRESHOLD = 0.5


class Kind(NamedTuple):
    pattern: str
    score: float
    checked: float = 0.0
    words: str = ""
    near: float = 0.0


_LOCAL = r"[A-Za-z0-9._%+-]"
KINDS = {
    "email": Kind(
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9, words="mail|email|contact|write", near=0.1,
    ),
    "ip": Kind(
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.6, words="ip|address|host|server", near=0.3,
    ),
    # A longest run of digits with single blanks or hyphens between them, of 13 to 19 digits.
    "card": Kind(
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
        0.3, checked=0.5, words="card|visa|credit|payment|carte|karte|tarjeta", near=0.2,
    ),
    "phone": Kind(
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.6, words="phone|telephone|telefon|call|tel|mobile|fax", near=0.3,
    ),
    "iban": Kind(
        r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}(?![A-Za-z0-9])))[A-Z]{2}",
        0.2, checked=0.6, words="iban|account|bank|konto|kontonummer|compte|cuenta", near=0.2,
    ),
    "ssn": Kind(
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3, words="ssn|social security|tax", near=0.4,
    ),
}

#: Context words count as whole words, in the plural too.
_WHOLE = r"(?<=[^\p{{L}}\p{{N}}])(?:{})s?(?![\p{{L}}\p{{N}}])"
#: Signs that are taken of a match, if what follows is only looked at (group 1).
_TAKEN = {"iban": 2}
#: Letters and digits of account numbers by country (ISO 13616).
IBAN_SIZES = {
    country: int(part[:2]) for part in (
        "15 NO", "16 BE", "18 DK FI FK FO GL NL SD", "19 MK SI", "20 AT BA EE KZ LT LU MN XK",
        "21 CH HR LI LV", "22 BG BH CR DE GB GE IE ME RS VA", "23 AE GI IL IQ OM SO TL",
        "24 AD CZ ES MD PK RO SA SE SK TN VG", "25 LY PT ST", "26 IS TR",
        "27 BI DJ FR GR IT MC MR SM", "28 AL AZ BY CY DO GT HN HU LB NI PL SV",
        "29 BR EG PS QA UA", "30 JO KW MU YE", "31 MT SC", "32 LC", "33 RU",
    ) for country in part[3:].split()
}

_SPAN = "struct<start:int,end:int,value:string,before:string>"
_KEPT = f"struct<end:int,kept:array<{_SPAN}>>"
_CHUNKS = f"struct<end:int,kept:array<array<{_SPAN}>>>"
#: Elements of an array that are added up, or filtered in order, together: what an ``aggregate``
#: holds is copied at each step, so long arrays are taken in chunks.
CHUNK = 128


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, one: total + one)


def _chunks(values: Column) -> Column:
    """An array that isn't empty, in chunks."""
    last = F.floor((F.size(values) - 1) / CHUNK).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda n: F.slice(values, n * CHUNK + 1, F.lit(CHUNK))
    )


def _sums_before(values: Column) -> Column:
    """For each of some whole numbers the sum of all before it."""
    def within(part: Column, base: Column) -> Column:
        return F.transform(part, lambda _, n: base + _sum(F.slice(part, F.lit(1), n)))

    return _let(_chunks(values), lambda cut: _let(
        F.transform(cut, _sum), lambda totals: F.flatten(F.transform(cut, lambda part, n: _let(
            _sum(F.slice(totals, F.lit(1), n)), lambda base: within(part, base))))
    ))


def _located(text: Column, matches: Column, pattern: str, taken: int | None = None) -> Column:
    """Matches with their positions: the texts between them are measured, too.

    The pattern takes the first ``taken`` signs of a match, or all of it.
    """
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("value"))

    def own(value: Column) -> Column:
        return value if taken is None else F.left(value, F.lit(taken))

    cut = F.transform(pairs, lambda pair: F.struct(
        F.length(pair["gap"]).alias("gap"), _last(pair["gap"]).alias("tail"), pair["value"].alias("value"),
    ))
    # So many matches and gaps reach over the window, however short they are.
    reach = (WINDOW + 1) // (taken or 4) + 2

    def spans(found: Column, sums: Column, seen: Column) -> Column:
        def shown(one: Column, n: Column) -> Column:
            start = F.get(sums, n) + one["gap"]
            first = F.greatest(n + 2 - reach, F.lit(1))
            before = _last(F.array_join(F.slice(seen, first, n + 2 - first), ""))
            return F.struct(
                start.alias("start"), (start + F.length(one["value"])).alias("end"),
                one["value"].alias("value"), F.lower(before).alias("before"),
            ).cast(_SPAN)

        return F.transform(found, shown)

    located = _let(cut, lambda found: _let(
        _sums_before(F.transform(found, lambda one: one["gap"] + F.length(own(one["value"])))),
        lambda sums: _let(
            # A blank stands for the start of the text.
            F.transform(found, lambda one, n: F.concat(
                F.when(n == 0, " ").otherwise(_last(own(F.get(found, n - 1)["value"]))), one["tail"])),
            lambda seen: spans(found, sums, seen),
        ),
    ))
    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.size(matches) > 0, located).otherwise(none)


def _last(value: Column) -> Column:
    """The window before a match, and one character more to see where its first word begins."""
    return F.right(value, F.lit(WINDOW + 1))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a text pass Luhn's check."""
    ones = F.split(F.reverse(_digits(value)), "(?!^)(?!$)")

    def add(total: Column, one: Column, place: Column) -> Column:
        twice = one * (1 + place % 2)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    numbered = F.transform(ones, lambda one, place: add(F.lit(0), one.cast("int"), place))
    return F.aggregate(numbered, F.lit(0), lambda total, one: total + one) % 10 == 0


def mod_97(value: Column) -> Column:
    """Whether an account number leaves 1 by mod 97, its first four signs put last."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, one: Column) -> Column:
        code = F.ascii(one)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise(
            (rest * 10 + code - 48) % 97
        )

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step) == 1


def _account(value: Column) -> Column:
    """The account number that a text begins with, or null."""
    words = F.split(value, " ")
    starts = F.transform(
        F.sequence(F.lit(1), F.size(words)),
        lambda n: F.array_join(F.slice(words, F.lit(1), n), " "),
    )

    def size(start: Column) -> Column:
        return F.length(F.regexp_replace(start, r"\x20", ""))

    valid = F.filter(starts, lambda start: (size(start) >= 15) & mod_97(start))
    sizes = F.create_map(*[F.lit(x) for pair in IBAN_SIZES.items() for x in pair])
    usual = F.filter(
        valid, lambda start: size(start) == F.try_element_at(sizes, F.left(value, F.lit(2)))
    )
    return F.coalesce(F.get(usual, F.lit(0)), F.get(F.reverse(valid), F.lit(0)))


def _accounts(located: Column) -> Column:
    """Account numbers at the places where they may begin, without overlap."""
    cut = F.transform(located, lambda span: F.struct(span.alias("span"), _account(span["value"]).alias("value")))
    held = F.transform(
        F.filter(cut, lambda x: x["value"].isNotNull()),
        lambda x: F.struct(
            x["span"]["start"].alias("start"),
            (x["span"]["start"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value"), x["span"]["before"].alias("before"),
        ).cast(_SPAN),
    )

    none = F.array().cast(f"array<{_SPAN}>")

    def step(state: Column, span: Column) -> Column:
        return F.when(span["start"] >= state["end"], F.struct(
            span["end"].alias("end"), F.concat(state["kept"], F.array(span)).alias("kept"),
        ).cast(_KEPT)).otherwise(state)

    def chunk(state: Column, part: Column) -> Column:
        begin = F.struct(state["end"].alias("end"), none.alias("kept")).cast(_KEPT)
        return _let(F.aggregate(part, begin, step), lambda found: F.struct(
            found["end"].alias("end"),
            F.concat(state["kept"], F.array(found["kept"])).alias("kept"),
        ).cast(_CHUNKS))

    return _let(held, lambda spans: F.when(F.size(spans) > 1, F.aggregate(
        _chunks(spans), F.from_json(F.lit('{"end":0,"kept":[]}'), _CHUNKS), chunk,
        lambda state: F.flatten(state["kept"]),
    )).otherwise(spans))


def _holds(kind: str, value: Column) -> Column:
    if kind == "card":
        return luhn(value)
    if kind == "ip":
        # A part that is all zeros ends behind them.
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?|(?<=0))"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _scored(kind: str, located: Column) -> Column:
    rule = KINDS[kind]

    def shown(span: Column) -> Column:
        near = F.when(span["before"].rlike(_WHOLE.format(rule.words)), rule.near).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
            span["value"].alias("value"),
            F.least(F.lit(1.0), near + rule.score + rule.checked).alias("score"),
        )

    if kind == "iban":
        valid = F.transform(_accounts(located), shown)
    else:
        valid = F.transform(F.filter(located, lambda span: _holds(kind, span["value"])), shown)
    if kind in BASE:
        return valid
    return F.filter(valid, lambda span: span["score"] >= THRESHOLD)


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds the spans by kind, as listed, then start: an array of
    (kind, start, end, value, score)."""
    body, *columns = fresh(docs, "_text", *[f"_{kind}" for kind in KINDS])
    found = docs.withColumn(body, whole(named(text)))
    found = found.withColumns({
        column: F.regexp_extract_all(
            named(body), F.lit(KINDS[kind].pattern), 1 if kind in _TAKEN else 0
        )
        for kind, column in zip(KINDS, columns, strict=True)
    })
    spans = [
        _scored(
            kind, _located(named(body), named(column), KINDS[kind].pattern, _TAKEN.get(kind))
        )
        for kind, column in zip(KINDS, columns, strict=True)
    ]
    return found.withColumn(out, F.concat(*spans)).drop(body, *columns)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets.

    Where spans overlap, the one that starts first counts, the longer if equal.
    """
    spans, = fresh(docs, "_spans")
    found = with_spans(docs, text, spans)
    state = "struct<at:int,out:array<string>>"
    order = F.array_sort(
        F.transform(named(spans), lambda s: F.struct(s["start"], (-s["end"]).alias("e"), s["kind"]))
    )
    body = whole(named(text))

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(body, done["at"] + 1, span["start"] - done["at"])
        return F.when(span["start"] >= done["at"], F.struct(
            (-span["e"]).alias("at"),
            F.concat(done["out"], F.array(gap, F.concat(F.lit("<"), span["kind"], F.lit(">"))))
            .alias("out"),
        ).cast(state)).otherwise(done)

    filled = F.aggregate(
        order, F.from_json(F.lit('{"at":0,"out":[]}'), state), step,
        lambda done: F.concat(
            F.array_join(done["out"], ""), F.substr(body, done["at"] + 1)
        ),
    )
    clean = F.when(F.size(named(spans)) > 0, filled).otherwise(named(text))
    return found.withColumn(text, clean).drop(spans)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def pii(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans."""
    found = with_spans(
        docs.select(named(key).alias("doc_id"), named(text).alias("text")), out="all"
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("all", lambda span: span["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("all", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"), F.size("all").cast("bigint").alias("n_spans"),
    )
