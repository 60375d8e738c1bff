"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled
text.  A document is parsed from left to right into longest phrases that occur
in the sample; the language whose automaton needs the fewest phrases, normalised by
the logarithm of its sample's length, wins.

* Sample: each language's labelled texts are spread over ``ROWS`` slots by a hash
  of the text; the text with the smallest second hash of each slot is taken,
  and of it a window of ``CHARS`` characters.  So a model has at most
  ``ROWS * CHARS`` characters for each language, at any size of input.
* Every label is learned.  Where all labels together have more windows than
  ``LANGUAGES`` languages may have, each keeps an equal number of them at most, and where
  one window each is still too many, windows get shorter.  This bounds what is
  broadcast: three transitions a character at most.  Only the labels themselves grow.
* Only letters and gaps between words count; case doesn't.  Every letter has a code.
* Whole texts are parsed, in blocks of ``BLOCK`` characters that many documents pass in step: a
  block's end ends a phrase.
* A text that is null or has no letter is ``und`` with score 0.  The score is the share
  of phrases that the best language saves against the second best; 1 if there is
  one language only.  Without any labelled row every document is ``und``.
* Ties go to the language that comes first by code point.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.common import fresh, in_small_batches, named, whole

ROWS = 64
CHARS = 1024
LANGUAGES = 16
BLOCK = 4096
#: Characters that are parsed together; a longer text in pieces.  This bounds memory.
TOGETHER = 2_000_000
#: Languages that are parsed together, and counts (a text, a language) that are held.
LANES = 16
HELD = 1 << 20
#: Steps (a state, a code) up to which they are a plain table, ten times as fast as a hash table.
PLAIN = 1 << 25
NO_LANGUAGE = "und"

# Codes of characters in a parse: a gap, a letter that no sample has, then letters.
_GAP, _OTHER = 0, 1


def training_sample(
    labelled: DataFrame, text: str, lang: str, rows: int = ROWS, chars: int = CHARS
) -> list[tuple[str, str]]:
    """(lang, sample): at most ``rows`` windows of ``chars`` characters per language,
    and of all languages as many characters as ``LANGUAGES`` may have (one each at least)."""
    usable = labelled.filter(named(text).isNotNull() & named(lang).isNotNull()).select(
        named(lang).alias("lang"), named(text).alias("text")
    ).select("*", F.xxhash64("text").alias("mark"))
    most = LANGUAGES * rows
    slots = (
        usable.groupBy("lang", F.pmod(F.col("mark"), F.lit(rows)).alias("slot"))
        .agg(F.min("mark").alias("mark")).select("lang", "mark")
    )
    chosen = slots.limit(most + 1).collect()
    if len(chosen) > most:
        share = _share(slots, rows, most)
        order = Window.partitionBy("lang").orderBy("mark")
        chosen = (
            slots.withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= share).drop("place").collect()
        )
        chars = max(1, chars * most // max(most, len(chosen)))
    spare = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    marks = labelled.sparkSession.createDataFrame(chosen, "lang string, mark bigint")
    if len(chosen) <= most:  # the texts needn't be shuffled to meet them
        marks = F.broadcast(marks)
    windows = usable.join(marks, ["lang", "mark"]).select(
        "lang", "mark",
        F.substr("text", (1 + F.pmod(F.col("mark"), spare)).cast("int"), F.lit(chars))
        .alias("sample"),
    )
    found = windows.groupBy("lang", "mark").agg(F.min("sample").alias("sample")).collect()
    return sorted((row["lang"], row["sample"]) for row in found)


def _share(slots: DataFrame, rows: int, most: int) -> int:
    """Windows that each language may keep (1 at least), so that all have ``most``."""
    sizes = slots.groupBy("lang").agg(F.count("*").alias("size"))
    labels = sizes.groupBy("size").agg(F.count("*").alias("labels")).collect()

    def held(share: int) -> int:
        return sum(row["labels"] * min(row["size"], share) for row in labels)

    return max([n for n in range(1, rows + 1) if held(n) <= most], default=1)


def plain(text: str) -> str:
    """Lower-case letters, with one blank for each gap between them."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all factors of a sequence."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and code not in follow[state]:
            follow[state][code] = new
            state = link[state]
        if state >= 0:
            target = follow[state][code]
            if length[state] + 1 == length[target]:
                link[new] = target
            else:
                twin = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and follow[state].get(code) == target:
                    follow[state][code] = twin
                    state = link[state]
                link[target] = link[new] = twin
        last = new
    return follow


class Model:
    """Automata of all languages as one table for parsing many texts in step.

    The table is a hash table with open addressing: ``keys`` holds state * width + code,
    ``targets`` the state that follows; -1 in both is a free place.  Up to ``PLAIN`` steps
    there is a plain table instead: ``steps[state * width + code]`` is the next state's
    place and the number of phrases that end by reading the code.
    """

    def __init__(self, samples: dict[str, list[str]]) -> None:
        plains = {lang: " ".join(map(plain, texts)) for lang, texts in sorted(samples.items())}
        plains = {lang: text for lang, text in plains.items() if text.strip()}
        letters = sorted(set().union(*plains.values()) - {" "})
        code_of = {c: at + 2 for at, c in enumerate(letters)} | {" ": _GAP}
        self.languages = list(plains)
        self.width = len(letters) + 2
        keys, targets, self.roots, size = [], [], [], 0
        for text in plains.values():
            follow = suffix_automaton([code_of[c] for c in text])
            states = np.repeat(np.arange(size, size + len(follow)), list(map(len, follow)))
            codes = np.fromiter((code for step in follow for code in step), dtype=np.int64)
            keys.append(states * self.width + codes)
            targets.append(size + np.fromiter(
                (state for step in follow for state in step.values()), dtype=np.int32
            ))
            self.roots.append(size)
            size += len(follow)
            del follow  # many times the room of what is kept
        keys = np.concatenate([np.zeros(0, dtype=np.int64), *keys])
        targets = np.concatenate([np.zeros(0, dtype=np.int32), *targets])
        self.steps = None
        if size * self.width <= PLAIN:
            self._spread(keys, targets, size)
        else:
            self._fill(keys, targets)
        self.weights = np.array([math.log2(len(text) + 2) for text in plains.values()])
        # Codes of all characters.
        self.codes = np.fromiter(
            (code_of.get(chr(c).lower(), _OTHER) if chr(c).isalpha() else _GAP
             for c in range(0x110000)), dtype=np.int32, count=0x110000,
        )

    def _spread(self, keys: np.ndarray, targets: np.ndarray, size: int) -> None:
        table = np.empty((size, self.width), dtype=np.int32)
        ahead = targets * np.int32(self.width) << 2
        for root, end in zip(self.roots, [*self.roots, size][1:], strict=True):
            first = np.full(self.width, root * self.width << 2 | 1, dtype=np.int32)
            own = keys // self.width == root
            first[keys[own] % self.width] = ahead[own]
            table[root:end] = first + 1  # a phrase ends, the code begins the next
            table[root] = first
        self.steps = table.ravel()
        self.steps[keys] = ahead

    def _fill(self, keys: np.ndarray, targets: np.ndarray) -> None:
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.targets = np.full(1 << self.bits, -1, dtype=np.int32)
        at = self._places(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            done = self.keys[at] == keys
            self.targets[at[done]] = targets[done]
            keys, targets, at = keys[~done], targets[~done], self._next(at[~done])

    def _places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).view(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        """The state that follows by each key, or -1."""
        at = self._places(keys)
        held, found = self.keys.take(at), self.targets.take(at)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        at = at[open_]
        while len(open_):
            at = self._next(at)
            held = self.keys.take(at)
            found[open_] = self.targets.take(at)
            more = (held != keys[open_]) & (held != -1)
            open_, at = open_[more], at[more]
        return found

    def _parsed(
        self, roots: np.ndarray, codes: np.ndarray, begin: np.ndarray, active: np.ndarray
    ) -> np.ndarray:
        """Phrases of every block by language."""
        lanes = len(roots)
        if self.steps is not None:
            roots = (roots * self.width).astype(np.int32)[:, None]
            state = np.repeat(roots, len(begin), axis=1)
            ended = np.zeros((lanes, len(begin)), dtype=np.int32)
            for step, count in enumerate(active.tolist()):
                found = self.steps.take(state[:, :count] + codes[begin[:count] + step])
                ended[:, :count] += found & 3
                np.right_shift(found, 2, out=state[:, :count])
            return ended + (state != roots)
        state = np.repeat(roots[:, None], len(begin), axis=1)
        ended = np.zeros((lanes, len(begin)), dtype=np.int32)
        for step, count in enumerate(active.tolist()):
            read = codes[begin[:count] + step].astype(np.int64)
            now = state[:, :count]
            found = self._follow((now * self.width + read).ravel())
            missed = np.flatnonzero(found < 0)
            if len(missed):
                # A phrase ends, unless none has begun; the code begins the next or is one itself.
                lane, place = np.divmod(missed, count)
                root = roots[lane]
                again = self._follow(root * self.width + read[place])
                alone = again < 0
                ended[lane, place] += (now[lane, place] != root).astype(np.int32) + alone
                found[missed] = np.where(alone, root, again)
            state[:, :count] = found.reshape(lanes, count)
        return ended + (state != roots[:, None])

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of every text by language, and its length in codes without outer gaps."""
        lanes = len(self.languages)
        flat = np.frombuffer(" ".join(t or "" for t in texts).encode("utf-32-le"), dtype="<u4")
        sizes = np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))
        codes = self.codes[flat]
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)[:len(codes)]
        # Gaps shrink to one, and go at the start and the end of a text.
        letter = codes != _GAP
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        codes, owner = codes[keep], owner[keep]
        lengths = np.bincount(owner, minlength=len(texts))
        last = np.cumsum(lengths) - 1
        closing = (lengths > 0) & (codes[np.maximum(last, 0)] == _GAP) if len(codes) else (
            np.zeros(len(texts), dtype=bool)
        )
        del flat, letter
        starts = np.cumsum(lengths) - lengths
        lengths = lengths - closing
        blocks = -(-lengths // BLOCK)
        of = np.repeat(np.arange(len(texts)), blocks)
        within = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = starts[of] + within * BLOCK
        size = np.minimum(lengths[of] - within * BLOCK, BLOCK)
        order = np.argsort(-size, kind="stable")
        of, begin, size = of[order], begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
        roots = np.array(self.roots, dtype=np.int64)
        total = np.zeros((lanes, len(texts)), dtype=np.int64)
        for first in range(0, lanes, LANES):
            ended = self._parsed(roots[first:first + LANES], codes, begin, active)
            for lane, own in enumerate(ended, first):
                total[lane] = np.bincount(of, weights=own, minlength=len(texts))
        return total.T, lengths

    def _add(self, total, lengths, owners: list[int], pieces: list[str]) -> None:
        if pieces:
            phrases, sizes = self.phrases(pieces)
            np.add.at(total, owners, phrases)
            np.add.at(lengths, owners, sizes)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score, entropy (bits a letter, by the best language)."""
        most = max(1, HELD // max(1, len(self.languages)))
        if len(texts) > most:
            return pd.concat(
                [self.predict(texts[at:at + most]) for at in range(0, len(texts), most)],
                ignore_index=True,
            )
        total = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        lengths = np.zeros(len(texts), dtype=np.int64)
        owners, pieces, held = [], [], 0
        for at, text in enumerate(texts):
            for begin in range(0, len(text or ""), TOGETHER):
                owners.append(at)
                pieces.append(text[begin:begin + TOGETHER])
                held += len(pieces[-1])
                if held >= TOGETHER:
                    self._add(total, lengths, owners, pieces)
                    owners, pieces, held = [], [], 0
        self._add(total, lengths, owners, pieces)
        known = lengths > 0
        lang = np.full(len(texts), NO_LANGUAGE, dtype=object)
        score, entropy = np.zeros(len(texts)), np.zeros(len(texts))
        if len(self.languages) and known.any():
            bits = total[known] * self.weights
            best = bits.argmin(axis=1)
            ranked = np.sort(bits, axis=1)
            lang[known] = np.array(self.languages, dtype=object)[best]
            score[known] = 1 - ranked[:, 0] / ranked[:, 1] if bits.shape[1] > 1 else 1.0
            entropy[known] = ranked[:, 0] / lengths[known]
        return pd.DataFrame({"lang_pred": lang, "score": score, "entropy": entropy})


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from rows with a text and a language."""
    samples: dict[str, list[str]] = {}
    for name, sample in training_sample(labelled, text, lang):
        samples.setdefault(name, []).append(sample)
    return Model(samples)


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score and entropy, under names that are free."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = object.__new__(Model)
        vars(own).update(shared.value)
        for part in parts:
            yield own.predict(part.tolist())

    predict = F.pandas_udf(run, "lang_pred string, score double, entropy double")
    found, = fresh(docs, "_found")
    names = fresh(docs, "lang_pred", "score", "entropy")
    return in_small_batches(docs).withColumn(found, predict(named(text))).select(
        *[named(name) for name in docs.columns],
        *[named(found)[field].alias(name)
          for field, name in zip(("lang_pred", "score", "entropy"), names, strict=True)],
    )


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text, mod 3, is 1."""
    return F.crc32(whole(key.cast("string"))) % 3 == 1


def identified(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy of every document."""
    model = fit(docs.filter(~held_out(named(key))), text, lang)
    rows = docs.select(
        named(key).alias("doc_id"), held_out(named(key)).alias("held_out"),
        named(text).alias("text"),
    )
    return with_language(rows, model).drop("text")


def keep_identified(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> DataFrame:
    """The documents that have a language, all columns as they are.

    Where no language could be learned, these are the documents with a letter.
    """
    model = fit(docs.filter(~held_out(named(key))), text, lang)
    if not model.languages:
        model = Model({"any": ["a"]})
    marked = with_language(docs, model, text)
    pred = marked.columns[len(docs.columns)]
    return marked.filter(named(pred) != NO_LANGUAGE).select(
        *[named(name) for name in docs.columns]
    )
