"""Texts of an Arrow batch as byte blocks of bounded size, and the words in them as hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
# Blanks after every text, so that no run of bytes crosses from one text into the next.
PAD = 4

_BASE = 0x9E3779B97F4A7C15  # odd, therefore invertible modulo 2**64
_MASK = (1 << 64) - 1


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by blanks, and the offsets; null is empty."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    padded = pc.binary_join_element_wise(
        filled, pa.scalar(" " * PAD, pa.large_string()), pa.scalar("", pa.large_string())
    )
    _, offsets, data = padded.buffers()
    n = len(padded)
    bounds = np.frombuffer(offsets, np.int64, n + 1, padded.offset * 8) if n else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds
    return np.frombuffer(data, np.uint8), bounds


def text_groups(bounds: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``size`` bytes; a longer text is a range of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def array_groups(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """The same ranges for an array of texts, before any of them is copied."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    yield from text_groups(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), size)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    result = []
    for base in (_BASE, inverse):
        values = np.full(length, base & _MASK, np.uint64)
        values[0] = 1
        result.append(np.cumprod(values, dtype=np.uint64))
    return result[0], result[1]


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def hashed_words(
    texts: pa.Array, between: np.ndarray = _BLANK
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last text, word hashes, offsets of each text's words) for groups of texts.

    Words are runs without the bytes marked in ``between`` (by default 0x20 and 0x09 to 0x0D), with
    A-Z in lower case. A word's hash is a polynomial of its bytes modulo 2**64, taken from one
    running sum over the block.
    """
    data, bounds = joined(texts)
    for first, last in text_groups(bounds):
        lo, hi = int(bounds[first]), int(bounds[last])
        part = data[lo:hi]
        inside = np.concatenate(([False], ~between[part], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        size = max(BLOCK_BYTES * 2, 1 << (hi - lo).bit_length())
        power, inverse = _powers(size)
        terms = _LOWER[part].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(terms * power[: hi - lo], out=sums[1:])
        words = mixed((sums[ends] - sums[starts]) * inverse[starts])
        yield first, last, words, np.searchsorted(starts, bounds[first : last + 1] - lo)
