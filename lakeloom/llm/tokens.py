"""Whole texts to token ids with the `tokenizers` library, each distinct word encoded once per worker.

The pre-tokenizer of the given vocabulary never joins characters across a space, and its normalizer
acts on each side of a space on its own, so the ids of a text are the ids of its space-separated
words one after the other. Words that are plain letters with punctuation behind are the ids of
the letters and then of the punctuation; every other word is encoded as it stands.
"""

from __future__ import annotations

import functools
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: distinct words kept per worker before the memory is given back
REMEMBERED = 600_000

#: letters that are single code points in NFC, and punctuation that cannot begin a contraction
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTER = "".join(c for c in map(chr, range(256)) if re.match(f"[{_LETTERS}]", c))
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _room(array: np.ndarray, needed: int) -> np.ndarray:
    """The array, made larger by halves until it has ``needed`` places."""
    if needed <= len(array):
        return array
    out = np.zeros(max(needed, len(array) * 3 // 2), dtype=array.dtype)
    out[: len(array)] = array
    return out


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the lists one after the other, and how many each has."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum())), size


class IdLists:
    """Numbered lists of ids, in one array."""

    def __init__(self) -> None:
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.size = np.zeros(1 << 16, dtype=np.int64)
        self.used = self.count = 0

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        n, used = self.count + len(size), self.used + len(flat)
        self.flat, self.start, self.size = _room(self.flat, used), _room(self.start, n), _room(self.size, n)
        self.flat[self.used : used] = flat
        self.size[self.count : n] = size
        self.start[self.count : n] = self.used + np.cumsum(size) - size
        self.used, self.count = used, n

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the lists of these numbers, one after the other, and where each begins and the last ends."""
        sizes = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        positions = np.repeat(self.start[numbers] - ends[:-1], sizes)
        positions += np.arange(ends[-1], dtype=np.int64)
        return self.flat[positions], ends


class Numbers(dict):
    """Numbers of keys, in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n

    def of(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of distinct keys, and the places of those that are new."""
        before = len(self)
        found = np.fromiter(map(self.__getitem__, keys.to_numpy(zero_copy_only=False).tolist()), np.int64, len(keys))
        return found, np.flatnonzero(found >= before)


class WordIds:
    """Ids of words, remembered; ``of`` encodes a column of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # letters as the pre-tokenizer hands them to the model, byte by byte
        spelt = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelt = str.maketrans({c: spelt(c)[0][0] for c in _LETTER if not c.isascii()})
        self._clear()

    def _clear(self) -> None:
        self.number, self.word = Numbers(), IdLists()
        self.letters, self.marks = (Numbers(), IdLists()), (Numbers(), IdLists())

    def _of_letters(self, words: list[str]) -> list[list[int]]:
        """Ids of runs of small letters: each is one unit of the pre-tokenizer."""
        tokenize, spelt = self.tokenizer.model.tokenize, self.spelt
        return [[t.id for t in tokenize(w if w.isascii() else w.translate(spelt))] for w in words]

    def _of_any(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)] if words else []

    def _part(self, column: pa.Array, known: tuple[Numbers, IdLists], encode) -> tuple[np.ndarray, IdLists]:
        """Numbers of a column's parts, and the lists that have their ids."""
        numbers, lists = known
        coded = column.dictionary_encode()
        found, fresh = numbers.of(coded.dictionary)
        lists.add(*_joined(encode(coded.dictionary.take(pa.array(fresh)).to_pylist())))
        return found[np.asarray(coded.indices)], lists

    def _learn(self, words: pa.Array) -> None:
        core = pc.utf8_rtrim(words, characters=_MARKS)
        plain = pc.match_substring_regex(core, f"^[{_LETTERS}]+$")
        split, odd = words.filter(plain), words.filter(pc.invert(plain))
        letters = self._part(pc.utf8_lower(core.filter(plain)), self.letters, self._of_letters)
        marks = self._part(pc.utf8_ltrim(split, characters=_LETTER), self.marks, self._of_any)
        rest, rest_size = _joined(self._of_any(odd.to_pylist()))
        is_plain = np.asarray(plain)
        # two pieces of each word: letters and marks, or all and nothing
        size = np.zeros((len(words), 2), dtype=np.int64)
        size[~is_plain, 0] = rest_size
        for side, (number, lists) in enumerate((letters, marks)):
            size[is_plain, side] = lists.size[number]
        owner = np.zeros((len(words), 2), dtype=np.int8)
        owner[is_plain] = 1, 2
        owner = np.repeat(owner.ravel(), size.ravel())
        flat = np.empty(len(owner), dtype=np.uint32)
        flat[owner == 0] = rest
        for side, (number, lists) in enumerate((letters, marks), 1):
            flat[owner == side] = lists.take(number)[0]
        self.word.add(flat, size.sum(axis=1))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (nulls are empty), and the bounds of each text in them."""
        if len(self.number) > REMEMBERED:
            self._clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = np.asarray(words.offsets)
        coded = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        mine, fresh = self.number.of(coded.dictionary)
        if len(fresh):
            self._learn(coded.dictionary.take(pa.array(fresh)))
        ids, ends = self.word.take(mine[np.asarray(coded.indices)])
        return ids, ends[offsets - offsets[0]]


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` appended to each text; the bounds that go with it."""
    n = len(bounds) - 1
    out = np.empty(len(ids) + n, dtype=np.uint32)
    closed = bounds[1:] + np.arange(n)
    inner = np.ones(len(out), dtype=bool)
    inner[closed] = False
    out[inner] = ids
    out[closed] = end
    return out, bounds + np.arange(n + 1)


def blocks(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Slices of a batch whose texts hold about ``limit`` bytes, whatever the length of a text."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    group = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
