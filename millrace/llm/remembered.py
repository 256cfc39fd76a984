"""A bounded memory of the ids of words, for tokenizers that take their time for each new word.

The words of a slice of texts are made distinct first. A distinct word is looked up by two 64-bit
hashes of its bytes, so that a remembered word takes some 40 bytes, whatever its length; only new
words go to the tokenizer. When the memory is full, an empty one takes its place and the full one
stays readable until that is full too.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

# Words of a memory; there are two of them.
REMEMBERED = 1_500_000
# Longer words are encoded every time.
KEY_BYTES = 64
# Words that are encoded at a time.
BATCH_WORDS = 20_000

_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def word_keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word, byte by byte; words over KEY_BYTES have the keys 0, 0."""
    _, bounds, values = words.buffers()
    offsets = np.frombuffer(bounds, np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    data = np.frombuffer(values or b"", np.uint8)
    starts, lengths = offsets[:-1], np.diff(offsets)
    keys = tuple(lengths.astype(np.uint64) * factor for factor in _FACTORS)
    rows = np.flatnonzero(lengths <= KEY_BYTES)
    for k in range(KEY_BYTES):
        rows = rows[lengths[rows] > k]
        if not len(rows):
            break
        byte = data[starts[rows] + k]
        for key, factor in zip(keys, _FACTORS):
            value = (key[rows] ^ byte) * factor
            key[rows] = value ^ (value >> np.uint64(29))
    for key in keys:
        key[lengths > KEY_BYTES] = 0
    return keys


def gathered(flat: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[ends[k]:ends[k + 1]] of all numbers k, joined, and how long each is."""
    starts = ends[numbers]
    lengths = ends[numbers + 1] - starts
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))], lengths


class _Remembered:
    """Ids of words. Each word has a number; words with keys are found again by these."""

    def __init__(self) -> None:
        self.first = np.zeros(0, np.uint64)  # ascending
        self.second = np.zeros(0, np.uint64)
        self.number = np.zeros(0, np.int64)
        # The ids of number k are flat[ends[k]:ends[k + 1]]. Both grow by doubling.
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.words = self.used = 0

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The numbers of words by their keys; -1 for a word that is not here."""
        if not len(self.first):
            return np.full(len(first), -1)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        here = (self.first[at] == first) & (self.second[at] == second)
        return np.where(here, self.number[at], -1)

    def add(self, first: np.ndarray, second: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of new words, which come in the order of their first keys.

        A word without keys, and the second of two words with one first key, cannot be found again.
        """
        n, self.words = self.words, self.words + len(first)
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.ends) <= self.words:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.ends[n + 1 : self.words + 1] = self.used + np.cumsum(lengths)
        self.used += len(flat)
        numbers = np.arange(n, self.words)
        keyed = np.diff(first, prepend=np.uint64(0)) != 0
        at = np.searchsorted(self.first, first[keyed])
        self.first, self.second = np.insert(self.first, at, first[keyed]), np.insert(self.second, at, second[keyed])
        self.number = np.insert(self.number, at, numbers[keyed])
        return numbers

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all numbers, joined, and how many each has."""
        return gathered(self.flat, self.ends, numbers)


def joined_ids(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and how many each word has."""
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())), lengths


class IdMemory:
    """Ids of words by ``encode``, which takes different words and gives what ``joined_ids`` gives."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.now, self.last = _Remembered(), _Remembered()

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has."""
        coded = words.dictionary_encode()
        numbers = self._numbers(coded.dictionary)
        return self.now.ids(numbers[coded.indices.to_numpy()])

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers in ``now`` of different words; those it lacks are added first."""
        if max(self.now.words, self.now.used // 8) > REMEMBERED:
            self.last, self.now = self.now, _Remembered()
        first, second = word_keys(words)
        order = np.argsort(first, kind="stable")
        first, second = first[order], second[order]
        number = self.now.find(first, second)
        lacking = np.flatnonzero(number < 0)
        old = self.last.find(first[lacking], second[lacking])
        places = lacking[old >= 0]
        number[places] = self.now.add(first[places], second[places], *self.last.ids(old[old >= 0]))
        new = lacking[old < 0]
        for at in range(0, len(new), BATCH_WORDS):
            places = new[at : at + BATCH_WORDS]
            flat, lengths = self.encode(words.take(pa.array(order[places])).to_pylist())
            number[places] = self.now.add(first[places], second[places], flat, lengths)
        by_word = np.zeros(len(words), np.int64)
        by_word[order] = number
        return by_word
