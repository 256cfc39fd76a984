"""Token files: texts as ids in compressed, checksummed blocks, in the order of doc_id.

Texts are range-partitioned and sorted by doc_id (equal ids by text), encoded with a tokenizer of
the tokenizers library, ended with one id each, and packed into blocks of whole documents by the
adaptive range coder. A block is one row of a parquet table; the table format gives task commits
and retries, the bytes of a block are complete in themselves. Reading decodes every block, checks
both checksums, and numbers the ids from the first document to the last.

Every white space ends a token of this vocabulary family, so a text's ids are those of its words
one after the other. The distinct words of a slice of texts are looked up in a bounded memory, and
only new ones go to the library; the ids of all its words are then gathered at once. A new word of
plain signs and Latin letters is cut here into the pieces that the vocabulary's rules give, and only the
library's model sees these; all other words take the library's whole way.

Defined cases: a null or empty text is the end id alone. Repeated rows are documents of their own,
next to each other; a null doc_id comes first. Strings that are special tokens of the vocabulary get
their single id, as in the library's plain call. A block holds at least BLOCK_IDS ids, or what a partition has, and a text of any length is
whole in one block. An empty table gives an empty file. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import range_coder
from millrace.llm.blocks import array_groups
from millrace.llm.remembered import IdMemory, gathered, joined_ids

BLOCK_IDS = 1 << 20
END_ID = 1
# Bytes of text that are split at a time.
SLICE_BYTES = 4_000_000

BLOCK_COLUMNS = (
    "part int, block int, start_in_part bigint, n_ids bigint, doc_ids array<bigint>, payload binary"
)

# How the vocabulary's words become pieces. Only under these settings are plain words cut here.
_RULES = {
    "truncation": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# Words of these signs alone are plain: printable ASCII without ' < > |, and the letters of Latin-1.
_PLAIN = re.compile("[!-&(-;=?-{}~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile("[a-zß-öø-ÿ]+|[0-9 ]|[^a-z0-9ß-öø-ÿ ]+")


class _PlainWords:
    """Ids of plain words: their lower-case pieces are made distinct and go to the tokenizer's model."""

    def __init__(self, tokenizer):
        from tokenizers import pre_tokenizers

        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {c: signs.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))}
        self.model = tokenizer.model

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        # A blank ends each word. It is the piece 0 and has no ids.
        pieces = _PIECE.findall(" ".join(words).lower() + " ")
        distinct = list(dict.fromkeys(chain([" "], pieces)))
        number = dict(zip(distinct, range(len(distinct))))
        numbers = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
        # The model knows the bytes of a letter by two signs; a second letter never is one of them.
        known = " ".join(distinct[1:])
        for letter, two in self.signs.items():
            known = known.replace(letter, two)
        found = [[token.id for token in self.model.tokenize(piece)] for piece in known.split(" ")]
        flat, lengths = joined_ids([[], *found])
        flat, lengths = gathered(flat, np.concatenate([[0], np.cumsum(lengths)]), numbers)
        return flat, np.diff(np.cumsum(lengths)[numbers == 0], prepend=0)


def _cuts_plainly(path: str) -> bool:
    """Whether a tokenizer's file has _RULES, and no added token that a plain word could hold."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    return (
        all(found[key] == value for key, value in _RULES.items())
        and found["model"]["type"] == "BPE"
        and not found["model"].get("dropout")
        and not any(_PLAIN.fullmatch(token["content"]) for token in found["added_tokens"])
    )


class _WordIds:
    """Ids of words by a tokenizer, most of them remembered."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = _PlainWords(self.tokenizer) if _cuts_plainly(path) else None
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.memory = IdMemory(self._encoded)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.array([self.plain is not None and _PLAIN.fullmatch(word) is not None for word in words], bool)
        rest = [words[i] for i in np.flatnonzero(~plain)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        if not plain.any():
            return joined_ids(found)
        first, n_first = self.plain.ids([words[i] for i in np.flatnonzero(plain)])
        then, n_then = joined_ids(found)
        # Back into the order of the words.
        numbers = np.empty(len(words), np.int64)
        numbers[plain] = np.arange(len(n_first))
        numbers[~plain] = np.arange(len(n_first), len(words))
        ends = np.cumsum(np.concatenate([[0], n_first, n_then]))
        return gathered(np.concatenate([first, then]), ends, numbers)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without an end id."""
        rows = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat, lengths = self.memory.ids(rows.flatten())
        bounds = rows.offsets.to_numpy() - rows.offsets[0].as_py()
        ends = np.concatenate([[0], np.cumsum(lengths)])[bounds].tolist()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> _WordIds:
    return _WordIds(path)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, pa.Array]]:
    """(doc_ids, texts) of a batch in runs of bounded size, or of one longer text."""
    for first, last in array_groups(batch.column(1), SLICE_BYTES):
        part = batch.slice(first, last - first)
        yield part.column(0).to_pylist(), part.column(1)


def blocks(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The blocks of a token file, BLOCK_COLUMNS, for ``docs`` (doc_id, text)."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer_path)
        part, number, start = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        size = 0
        end = np.array([end_id], np.int32)

        def block() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in parts], np.int64)
            payload = range_coder.pack(np.concatenate(parts), lengths, words.vocabulary)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                ],
                ["part", "block", "start_in_part", "n_ids", "doc_ids", "payload"],
            )

        for batch in batches:
            for doc_ids, texts in _slices(batch):
                for doc_id, ids in zip(doc_ids, words.ids(texts)):
                    names.append(doc_id)
                    parts.append(np.concatenate([ids, end]))
                    size += len(parts[-1])
                    if size >= block_ids:
                        yield block()
                        number, start, size, names, parts = number + 1, start + size, 0, [], []
        if parts:
            yield block()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    return ordered.mapInArrow(packed, BLOCK_COLUMNS)


def write_token_file(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    blocks(docs, tokenizer_path, end_id).write.parquet(path)


def read_token_file(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document of a token file.

    ``start`` counts the ids of all documents before it. Only one row per partition of the file,
    its number of ids, is brought together to number them.
    """
    file = spark.read.schema(BLOCK_COLUMNS).parquet(path)
    sizes = file.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = file.join(F.broadcast(offsets), "part").select(
        (F.col("start_in_part") + F.col("offset")).alias("start"), "doc_ids", "payload"
    )
    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if with_ids:
        columns += ", ids array<int>"

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, doc_ids = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                ids, lengths = range_coder.unpack(batch.column(2)[i].as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                raw = memoryview(ids).cast("B")
                sums = [
                    zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), lengths.tolist())
                ]
                arrays = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(start + ends - lengths, pa.int64()),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    cuts = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    arrays.append(pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32))))
                names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return placed.mapInArrow(unpacked, columns)
