"""Token ids of many texts at once, by a public tokenizer.

Words between ASCII white space are encoded when first seen and then looked up.  This
needs a tokenizer that drops white space and keeps words apart; others are told by a
test and then encode whole texts.  What a word may be reduced to before it is looked up
is tried out as well: whether a stop or comma behind Latin letters is kept apart,
whether case matters, and whether such letters reach the model byte by byte.

A worker remembers at most ``WORDS`` words, the most used of those it has met.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers

#: Words that a worker remembers, and bytes of text that it encodes at once.
WORDS = 250_000
TOGETHER = 8 << 20

#: Latin letters before U+0250 whose lower case is one such letter again, and one stop or comma.
_PLAIN = r"^[A-Za-zªµºÀ-ÖØ-öø-įı-ȹȻ-Ƚȿ-ɏ]+[.,]?$"


def pieces(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in pieces of whole texts, of some ``TOGETHER`` bytes or one text."""
    sizes = pc.binary_length(batch[text]).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes + 1) // TOGETHER
    bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(batch)]
    for start, stop in zip(bounds, bounds[1:], strict=False):
        if stop > start:
            yield batch.slice(start, stop - start)


def ragged(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of ``pool`` that begin at ``starts``, one behind the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    at = np.repeat((starts - (ends - sizes)).astype(np.int32), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return pool[at]


class Encoder:
    """A tokenizer and the words it has met."""

    def __init__(self, path: str, words: int = WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.words = words
        probe = "Some words,\n\tapart: 'tis 12 o'clock é Indeed, THE words. of"
        split = [x for word in probe.split() for x in self.one(word)]
        self.by_word = self.one(f" {probe} ") == split
        bytewise = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {char: bytewise.pre_tokenize_str(char)[0][0] for char in map(chr, range(0x250))}
        letters = ["some", "words", "the", "of", "thntblere", "ea", "éçaux", "größe", "ñœł"]
        self.direct = all(
            self.one(word) == self._model(word) == self.one(word.title())
            and all(self.one(word + end) == self._model(word) + self.one(end) for end in ".,")
            for word in letters
        )
        self.forget()

    def one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _model(self, word: str) -> list[int]:
        shown = word if word.isascii() else "".join([self.shown[char] for char in word])
        return [token.id for token in self.tokenizer.model.tokenize(shown)]

    def forget(self) -> None:
        """Start with the stop and the comma, which are words 0 and 1; word 2 is empty."""
        self.places: dict[str, int] = {}
        self.used = np.zeros(0, dtype=np.int64)
        self.starts, self.sizes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.pool, self.room = np.zeros(1 << 20, dtype=np.uint32), 0
        self._add([".", ",", ""], [self.one("."), self.one(","), []])

    def _add(self, words: list[str], found: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        count = int(sizes.sum())
        while self.room + count > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.room:self.room + count] = np.fromiter(
            chain.from_iterable(found), dtype=np.uint32, count=count
        )
        self.places.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words))))
        self.starts = np.concatenate([self.starts, self.room + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used = np.concatenate([self.used, np.zeros(len(words), dtype=np.int64)])
        self.room += count

    def _keep_used(self) -> None:
        """Keep the more used half of the words."""
        keep = np.zeros(len(self.sizes), dtype=bool)
        keep[np.argsort(-self.used, kind="stable")[:self.words // 2]] = True
        keep[:3] = True
        moved = np.cumsum(keep) - 1
        self.places = {word: int(moved[at]) for word, at in self.places.items() if keep[at]}
        pool = ragged(self.pool, self.starts[keep], self.sizes[keep])
        self.sizes, self.used = self.sizes[keep], self.used[keep] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.room = len(pool)
        self.pool = np.concatenate([pool, np.zeros(1 << 20, dtype=np.uint32)])

    def _stems(self, words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """What each word is looked up as, and which word (stop, comma, none) is behind it."""
        none = np.full(len(words), 2)
        if not self.direct:
            return words.dictionary_encode(), none
        plain = pc.match_substring_regex(words, _PLAIN)
        last = pc.if_else(plain, pc.utf8_slice_codeunits(words, -1), "")
        ends = np.where(pc.equal(last, ".").to_numpy(zero_copy_only=False), 0,
                        np.where(pc.equal(last, ",").to_numpy(zero_copy_only=False), 1, none))
        lower = pc.utf8_lower(words)
        stems = pc.if_else(pa.array(ends < 2), pc.utf8_slice_codeunits(lower, 0, -1), lower)
        return pc.if_else(plain, stems, words).dictionary_encode(), ends

    def _learn(self, words: list[str]) -> None:
        """Encode words that aren't known."""
        plain, other = [], []
        for word in words:
            low = self.direct and word.isalpha() and (word.isascii() or max(word) < "ɐ")
            (plain if low and word == word.lower() else other).append(word)
        self._add(plain, list(map(self._model, plain)))
        encoded = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        self._add(other, [found.ids for found in encoded])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of every text."""
        if not self.by_word:
            found = [self.one(text) for text in texts.to_pylist()]
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            return np.fromiter(
                chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum())
            ), sizes
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        stems, ends = self._stems(words.dictionary)
        distinct = stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.places) > self.words:
            self._keep_used()
        places = list(map(self.places.get, distinct))
        if None in places:
            self._learn([word for word, at in zip(distinct, places, strict=True) if at is None])
            places = list(map(self.places.get, distinct))
        rows = np.array(places, dtype=np.int64)[stems.indices.to_numpy(zero_copy_only=False)]
        self.used += np.bincount(rows, minlength=len(self.used))
        # Ids of each distinct word, stem and end, and then of all words.
        both = np.stack([rows, ends], axis=1).ravel()
        pool = ragged(self.pool, self.starts[both], self.sizes[both])
        own = self.sizes[rows] + self.sizes[ends]
        at = words.indices.to_numpy(zero_copy_only=False)
        sizes = own[at]
        ids = ragged(pool, (np.cumsum(own) - own)[at], sizes)
        owner = np.concatenate([[0], np.cumsum(sizes)])
        bounds = lists.offsets.to_numpy(zero_copy_only=False)
        bounds = bounds - bounds[0]
        return ids, owner[bounds[1:]] - owner[bounds[:-1]]


def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    kept = vars(tokenizers).setdefault("_kontor_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
