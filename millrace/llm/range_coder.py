"""Adaptive context mixing of token ids with arithmetic coding, in independent blocks.

A block is cut into lanes of equal length that are coded side by side: step k codes the k-th id
of every lane with numpy operations on whole lanes. All lanes share one model, which learns from
a step before the next one, so the model sees the whole block although it advances by lanes.

The model predicts an id three ways. Order 2 and order 1 remember the id that last followed the
two previous ids and the previous id, each with a confidence that grows with hits. Order 0 is the
adaptive frequency of every id. The orders are mixed by weights: for each pair of confidences an
adaptive distribution over "order 2 is right", "order 1 is right" and "neither" is coded first,
and in the last case the id itself under order 0.

Each lane has a carryless range coder with a 64-bit interval that emits 32-bit words. Nothing
passes from one block to another, and a checksum over the ids and one over the file bytes tell
a damaged block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"MTB2"
MAX_LANES = 8192
MIN_STEPS = 128
_HEADER = struct.Struct("<4sIIIIII")

_CONTEXT_BITS = 18
_MIX_BITS = 12
_CONFIDENT = 3
# Confidence after a miss, then after a hit, by the one before.
_NEXT_TRUST = np.array([0, 0, 1, 2, 1, 2, 3, 3], np.int8)
_REFRESH = 8  # steps between two rebuilds of the order-0 distribution
_GAIN = 24
_ORDER_0_LIMIT = 1 << 24
_MIX_LIMIT = 1 << 20
_WORD = np.uint64(32)
_LOW_WORD = np.uint64(0xFFFFFFFF)
_ONE = np.uint64(1)


class _Model:
    """What both directions know before a step, and what they learn from it."""

    def __init__(self, vocabulary: int, lanes: int):
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)
        self.guess_1 = np.zeros(vocabulary, np.int64)
        self.trust_1 = np.zeros(vocabulary, np.int8)
        self.guess_2 = np.zeros(1 << _CONTEXT_BITS, np.int64)
        self.trust_2 = np.zeros(1 << _CONTEXT_BITS, np.int8)
        self.mix = np.tile(np.array([8, 4, 20], np.int64), (2 * (_CONFIDENT + 1) ** 2, 1))
        self.counts = np.ones(vocabulary, np.int64)
        self.recent: list[np.ndarray] = []
        self._refresh_mix()
        self._refresh_order_0()

    def _refresh_mix(self) -> None:
        total = self.mix.sum(axis=1, keepdims=True)
        self.mix[total[:, 0] > _MIX_LIMIT] >>= 1
        share = (self.mix * ((1 << _MIX_BITS) - 3)) // np.maximum(1, self.mix.sum(axis=1, keepdims=True)) + 1
        share[:, 2] += (1 << _MIX_BITS) - share.sum(axis=1)
        # By context times 3 plus symbol; and the two inner bounds by context.
        self.mix_width = share.astype(np.uint64).ravel()
        starts = (np.cumsum(share, axis=1) - share).astype(np.uint64)
        self.mix_start = starts.ravel()
        self.mix_bounds = np.ascontiguousarray(starts[:, 1]), np.ascontiguousarray(starts[:, 2])

    def _refresh_order_0(self) -> None:
        if self.recent:
            seen = np.concatenate(self.recent)
            self.counts += _GAIN * np.bincount(seen, minlength=len(self.counts))
            self.recent = []
        while self.counts.sum() >= _ORDER_0_LIMIT:
            self.counts = (self.counts + 1) >> 1
        self.start = np.zeros(len(self.counts) + 1, np.uint64)
        np.cumsum(self.counts, out=self.start[1:], dtype=np.uint64)
        self.total = self.start[-1]
        self.width = self.counts.astype(np.uint64)
        # Half as wide, for the search in decoding.
        self.search = self.start.astype(np.uint32)

    def expect(self) -> np.ndarray:
        """The mixing context of each lane; the guesses are kept for the step."""
        mixed = self.last * 0x9E3779B1 + self.before * 0x85EBCA6B
        self.slot = (mixed & 0xFFFFFFFF) >> (32 - _CONTEXT_BITS)
        self.one, self.two = self.guess_1.take(self.last), self.guess_2.take(self.slot)
        self.c1, self.c2 = self.trust_1.take(self.last), self.trust_2.take(self.slot)
        return (self.c2.astype(np.int64) * (_CONFIDENT + 1) + self.c1) * 2 + (self.one == self.two)

    def learn(self, ids: np.ndarray, mixed: np.ndarray) -> None:
        """Take in what a step coded; ``mixed`` is context times 3 plus symbol."""
        for key, guess, trust, said, was in (
            (self.last, self.guess_1, self.trust_1, self.one, self.c1),
            (self.slot, self.guess_2, self.trust_2, self.two, self.c2),
        ):
            state = was + (said == ids) * np.int8(_CONFIDENT + 1)
            trust[key] = _NEXT_TRUST.take(state)
            wrong = np.flatnonzero(state == 0)
            guess[key.take(wrong)] = ids.take(wrong)
        self.mix += np.bincount(mixed, minlength=self.mix.size).reshape(self.mix.shape)
        self._refresh_mix()
        self.recent.append(ids)
        if len(self.recent) == _REFRESH:
            self._refresh_order_0()
        self.before, self.last = self.last, ids


def _renewed(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Lanes whose interval has become narrower than a word; one that straddles a word is cut."""
    short = np.flatnonzero(width <= _LOW_WORD)
    if len(short):
        a, w = low[short], width[short]
        across = ((a ^ (a + w - _ONE)) >> _WORD) != 0
        if across.any():
            cut = short[across]
            width[cut] = (~low[cut] + _ONE) & _LOW_WORD
    return short


def _lanes(n: int) -> tuple[int, int]:
    lanes = min(MAX_LANES, max(1, n // MIN_STEPS))
    steps = -(-n // lanes)
    return -(-n // steps), steps


def encode(ids: np.ndarray, vocabulary: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(number of lanes, words of each lane, all words lane by lane) of at least one id."""
    lanes, steps = _lanes(len(ids))
    table = np.zeros(lanes * steps, np.int64)
    table[: len(ids)] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    model = _Model(vocabulary, lanes)
    low = np.zeros(lanes, np.uint64)
    width = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    owners: list[np.ndarray] = []
    words: list[np.ndarray] = []

    def emit() -> None:
        short = _renewed(low, width)
        if len(short):
            owners.append(short)
            words.append((low[short] >> _WORD).astype(np.uint32))
            low[short] <<= _WORD
            width[short] <<= _WORD

    for now in table:
        context = model.expect()
        symbol = np.where(now == model.two, 0, np.where(now == model.one, 1, 2))
        mixed = context * 3 + symbol
        part = width >> np.uint64(_MIX_BITS)
        low += part * model.mix_start.take(mixed)
        np.multiply(part, model.mix_width.take(mixed), out=width)
        emit()
        rest = np.flatnonzero(symbol == 2)
        if len(rest):
            wanted = now.take(rest)
            start = model.start.take(wanted)
            part = width.take(rest) // model.total
            low[rest] += part * start
            width[rest] = part * model.width.take(wanted)
            emit()
        model.learn(now, mixed)
    # Any number inside the interval ends a lane; the next multiple of a word needs one word.
    owners.append(np.arange(lanes))
    words.append(((low + _LOW_WORD) >> _WORD).astype(np.uint32))
    owner, word = np.concatenate(owners), np.concatenate(words)
    order = np.argsort(owner, kind="stable")
    return lanes, np.bincount(owner, minlength=lanes).astype(np.uint32), word[order]


def decode(n: int, vocabulary: int, lengths: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ``n`` ids that ``encode`` was given."""
    lanes, steps = _lanes(n)
    # Behind a lane's words the decoder reads zeros; they come from the padding at the end.
    ends = np.cumsum(lengths.astype(np.int64))
    at = ends - lengths
    source = np.concatenate([words.astype(np.uint64), np.zeros(1, np.uint64)])
    nothing = len(words)

    def take(which: np.ndarray) -> np.ndarray:
        place = at[which]
        at[which] = place + 1
        return source[np.where(place < ends[which], place, nothing)]

    every = np.arange(lanes)
    code = take(every) << _WORD
    code |= take(every)
    model = _Model(vocabulary, lanes)
    low = np.zeros(lanes, np.uint64)
    width = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    table = np.zeros((steps, lanes), np.int64)

    def fill() -> None:
        short = _renewed(low, width)
        if len(short):
            low[short] <<= _WORD
            width[short] <<= _WORD
            code[short] = (code[short] << _WORD) | take(short)

    for now in table:
        context = model.expect()
        part = width >> np.uint64(_MIX_BITS)
        value = (code - low) // part
        symbol = (value >= model.mix_bounds[0].take(context)).astype(np.int64)
        symbol += value >= model.mix_bounds[1].take(context)
        mixed = context * 3 + symbol
        low += part * model.mix_start.take(mixed)
        np.multiply(part, model.mix_width.take(mixed), out=width)
        fill()
        now[:] = np.where(symbol == 0, model.two, model.one)
        rest = np.flatnonzero(symbol == 2)
        if len(rest):
            part = width.take(rest) // model.total
            value = np.minimum((code.take(rest) - low.take(rest)) // part, model.total - _ONE).astype(np.uint32)
            # Sorted values are searched three times as fast.
            order = np.argsort(value)
            rest, part = rest.take(order), part.take(order)
            wanted = np.searchsorted(model.search, value.take(order), side="right") - 1
            low[rest] += part * model.start.take(wanted)
            width[rest] = part * model.width.take(wanted)
            now[rest] = wanted
            fill()
        model.learn(now, mixed)
    return np.ascontiguousarray(table.T).reshape(-1)[:n]


def pack(ids: np.ndarray, doc_lengths: np.ndarray, vocabulary: int) -> bytes:
    """One block of a token file: header, document lengths, lane lengths, words, checksum."""
    raw = ids.astype("<u4").tobytes()
    if len(ids) and int(ids.max()) >= vocabulary:
        raise ValueError(f"id {int(ids.max())} is outside a vocabulary of {vocabulary}")
    lanes, lengths, words = (
        encode(ids, vocabulary) if len(ids) else (0, np.zeros(0, np.uint32), np.zeros(0, np.uint32))
    )
    head = _HEADER.pack(MAGIC, len(doc_lengths), len(ids), lanes, len(words), vocabulary, zlib.crc32(raw))
    body = b"".join(
        [head, doc_lengths.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), words.astype("<u4").tobytes()]
    )
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, document lengths) of a block; a damaged one raises ValueError."""
    if len(block) < _HEADER.size + 4 or struct.unpack_from("<I", block, len(block) - 4)[0] != zlib.crc32(
        memoryview(block)[:-4]
    ):
        raise ValueError("damaged block: wrong checksum")
    magic, n_docs, n, lanes, n_words, vocabulary, checksum = _HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    numbers = np.frombuffer(block, "<u4", n_docs + lanes + n_words, _HEADER.size)
    doc_lengths, lengths, words = np.split(numbers, [n_docs, n_docs + lanes])
    ids = decode(n, vocabulary, lengths, words) if n else np.zeros(0, np.int64)
    ids = ids.astype("<u4")
    if zlib.crc32(ids.tobytes()) != checksum:
        raise ValueError("damaged block: wrong ids")
    return ids, doc_lengths
