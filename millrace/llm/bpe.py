"""Byte-level BPE: texts to token ids and back, by the ranks of a public vocabulary file.

Each match of the split pattern is encoded by itself: a piece that is a token is that token,
otherwise the adjacent pair with the lowest rank, the leftmost of equal ones, is merged until no
pair has a rank. A segment tree over the byte positions of the piece holds that leftmost minimum.
A merge changes at most three leaves, those of the neighbours that are still alive, so a piece of
n bytes costs O(n log n) however long it is.

Defined cases: null and empty texts have no ids, and decode to nothing. Repeated rows get equal
ids; ties of rank go to the left. Texts are read whole. Decoding joins the tokens' bytes; it gives
the exact UTF-8 bytes of the text. Other columns stay as they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import array_groups
from millrace.llm.remembered import IdMemory, joined_ids

# Bytes of text that are encoded at a time.
SLICE_BYTES = 1 << 21

_POSITION_BITS = 40  # and 20 bits of rank
_POSITION = (1 << _POSITION_BITS) - 1
_NONE = 1 << 62


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after = list(range(1, n + 2))  # start of the next live part; n behind the last one
    before = list(range(-1, n))
    width = 1 << (n - 1).bit_length()
    tree = [_NONE] * (2 * width)
    rank_of = ranks.get
    # A node's key is the rank of a pair and the position where it starts, in one number.
    for i in range(n - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            tree[width + i] = rank << _POSITION_BITS | i
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    while (least := tree[1]) != _NONE:
        i = least & _POSITION
        j = after[i]
        end = after[i] = after[j]
        before[end] = i
        rank = rank_of(piece[i : after[end]]) if end < n else None
        changed = [(j, _NONE), (i, _NONE if rank is None else rank << _POSITION_BITS | i)]
        if i:
            h = before[i]
            rank = rank_of(piece[h:end])
            changed.append((h, _NONE if rank is None else rank << _POSITION_BITS | h))
        for position, key in changed:
            node = position + width
            if tree[node] == key:
                continue
            tree[node] = key
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                if other < key:
                    key = other
                if tree[node] == key:
                    break
                tree[node] = key
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


# Texts of these letters alone are split by the standard library, several times as fast: in
# them \p{L}, \p{N} and \s are the ranges written out below. All others take the full pattern.
_PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_plain = re.compile(f"[\t-\r -~{_PLAIN_LETTERS}]*+")


@lru_cache(maxsize=2)
def _splitters(pattern: str) -> tuple[Callable, Callable]:
    ranges = (
        pattern.replace(r"[^\s\p{L}\p{N}]", f"[^\t-\r 0-9{_PLAIN_LETTERS}]")
        .replace(r"\p{L}", f"[{_PLAIN_LETTERS}]")
        .replace(r"\p{N}", "[0-9]")
        .replace(r"\S", "[^\t-\r ]")
        .replace(r"\s", "[\t-\r ]")
    )
    full = regex.compile(pattern).findall
    return full, re.compile(ranges).findall if "\\" not in ranges else full


@lru_cache(maxsize=2)
def _memory(path: str) -> IdMemory:
    ranks = ranks_of(path)
    return IdMemory(lambda pieces: joined_ids([merged(piece.encode(), ranks) for piece in pieces]))


def _encoded(texts: list[str | None], path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and where those of each begin and the last end."""
    full, plain = _splitters(pattern)
    pieces: list[str] = []
    bounds = [0]
    for text in texts:
        if text:
            pieces += (plain if _plain.fullmatch(text) else full)(text)
        bounds.append(len(pieces))
    ids, lengths = _memory(path).ids(pa.array(pieces, pa.string()))
    return ids, np.concatenate([[0], np.cumsum(lengths)])[bounds]


def encode_text(text: str | None, path: str, pattern: str) -> list[int]:
    return _encoded([text], path, pattern)[0].tolist()


@lru_cache(maxsize=2)
def _tokens(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens by id, one after the other, and where each starts."""
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens], dtype=np.int64)])
    return np.frombuffer(b"".join(tokens), np.uint8), starts


def _decoded(ids: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids, one after the other, and where those of each id end."""
    data, starts = _tokens(path)
    lengths = starts[ids + 1] - starts[ids]
    ends = np.cumsum(lengths)
    return data[np.repeat(starts[ids] - ends + lengths, lengths) + np.arange(int(lengths.sum()))], ends


def decode_ids(ids: list[int] | None, path: str) -> bytes:
    return _decoded(np.array(ids or [], np.int64), path)[0].tobytes()


def with_ids(docs: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of its text, array<int>, and the bytes that these decode to, binary.

    Both columns come from one pass, in slices of texts of bounded size. Columns of the input with
    their names are replaced.
    """
    kept = [name for name in docs.columns if name not in (ids, decoded)]
    schema = T.StructType([docs.schema[name] for name in kept])
    schema = schema.add(ids, T.ArrayType(T.IntegerType())).add(decoded, T.BinaryType())
    at = kept.index("text")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in array_groups(batch.column(at), SLICE_BYTES):
                part = batch.slice(first, last - first)
                flat, bounds = _encoded(part.column(at).to_pylist(), path, pattern)
                text, ends = _decoded(flat, path)
                places = np.concatenate([[0], ends])[bounds].astype(np.int32)
                columns = [
                    *part.columns,
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                    pa.Array.from_buffers(
                        pa.binary(), part.num_rows, [None, pa.py_buffer(places), pa.py_buffer(text)]
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, [*kept, ids, decoded])

    return docs.select(*(F.col(f"`{name}`") for name in kept)).mapInArrow(coded, schema)
