import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from corpus import documents
from tokenizers import Tokenizer

from millrace.llm import range_coder, remembered, token_files
from millrace.session import working_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 1000, 70_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), np.minimum(rng.zipf(1.4, n), 49407), np.full(n, 49407), np.arange(n) % 7):
        lengths = np.array([n // 3, n - n // 3])
        back, got = range_coder.unpack(range_coder.pack(ids, lengths, 49408))
        assert back.tolist() == ids.tolist() and got.tolist() == lengths.tolist()


def test_the_model_learns():
    ids = np.tile(np.random.default_rng(1).integers(0, 49408, 3000), 40)
    assert len(range_coder.pack(ids, np.array([len(ids)]), 49408)) < len(ids) / 2


def test_damage_is_found():
    block = range_coder.pack(np.arange(500), np.array([500]), 49408)
    for at in (0, 10, len(block) // 2, len(block) - 1):
        with pytest.raises(ValueError):
            range_coder.unpack(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])
    with pytest.raises(ValueError):
        range_coder.unpack(block[:-5])
    with pytest.raises(ValueError):
        range_coder.pack(np.array([5]), np.array([1]), 5)


def test_words_equal_the_library(library):
    rng = random.Random(1)
    pool = "abc  \n\t\r\x0b\x0c\x1c\x85\xa0'stvlldmeéßñÀΣσς0129²½٣!?.,—中文日本한국🙂́ µªº×÷İI"
    words = token_files._WordIds(PATH)
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(2000)]
    special = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]
    texts += ["".join(rng.choice([*special, "a", " ", "é ", "\n"]) for _ in range(rng.randrange(9))) for _ in range(300)]
    texts += ["a <|endoftext|> b", "", None, " ", "\n\t"]
    for text, ids in zip(texts, words.ids(pa.array(texts, pa.string()))):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids


def expected_rows(library, rows):
    start, result = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        result.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return result


def test_file_equals_the_library(spark, small, library, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    path = working_path(spark, "file")
    token_files.blocks(docs.repartition(3), PATH, block_ids=5000).write.parquet(path)
    found = token_files.read_token_file(spark, path)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(found.collect())
    assert [tuple(r)[:4] for r in got] == expected_rows(library, rows)
    for row in got[:20]:
        assert row["ids"][-1] == 1 and len(row["ids"]) == row["n_tokens"]


def test_awkward_and_empty(spark, awkward, empty, library):
    path = working_path(spark, "file")
    token_files.write_token_file(awkward, path, PATH)
    got = token_files.read_token_file(spark, path, with_ids=False).collect()
    assert len(got) == 14
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    by_start = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert by_start == [r[0] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    sums = sorted((str(r[0]), *r[2:]) for r in expected_rows(library, rows))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sums
    path = working_path(spark, "file")
    token_files.write_token_file(empty, path, PATH)
    assert token_files.read_token_file(spark, path).collect() == []


def test_memory_of_words_stays_bounded(monkeypatch, library):
    monkeypatch.setattr(remembered, "REMEMBERED", 5)
    words = token_files._WordIds(PATH)
    for i in range(60):
        text = f"word{i % 9} other{i % 4}"
        assert words.ids(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert words.memory.now.words <= 10 and words.memory.last.words <= 10


def test_words_without_keys_of_their_own(monkeypatch, library):
    """Long words, and words whose keys are equal or zero, are encoded every time."""
    texts = [" ".join([f"x{i}" * (1 + i * 9 % 40) for i in range(30)] + ["same", "", "éé"])] * 3
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in token_files._WordIds(PATH).ids(pa.array(texts))] == expected
    plain = remembered.word_keys

    def few(words):
        first, second = plain(words)
        return first % np.uint64(3), second

    monkeypatch.setattr(remembered, "word_keys", few)
    words = token_files._WordIds(PATH)
    for _ in range(3):
        assert [x.tolist() for x in words.ids(pa.array(texts))] == expected


def test_rows_of_blocks(spark):
    docs = documents(spark, [(i, "a b c") for i in range(50)])
    rows = token_files.blocks(docs.coalesce(1), PATH, block_ids=40).collect()
    assert sum(r["n_ids"] for r in rows) == 200 and all(r["n_ids"] >= 40 or r is rows[-1] for r in rows[:-1])


def test_plain_words_do_without_the_library_s_whole_way(library):
    """Only words with other signs than printable ASCII and Latin-1 letters are encoded one by one."""
    rng = random.Random(2)
    pool = "abcXYZ019.,!?&%#$*()[]{}/\\\"=~-_^`@:;+ÀÉÖØÞßàéñöøüÿ"
    plain = ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    other = ["it's", "a|b", "<|endoftext|>", "x²", "a×b", "σς", "é", "日本", "µm", "İx", "a\x1cb"]
    words = token_files._WordIds(PATH)
    seen = []

    class Counted:
        def encode_batch_fast(self, texts, **more):
            seen.extend(texts)
            return library.encode_batch_fast(texts, **more)

    words.tokenizer = Counted()
    for some in ([*plain, *other], plain, other, []):
        rng.shuffle(some)
        flat, lengths = words._encoded(some)
        expected = [library.encode(w, add_special_tokens=False).ids for w in some]
        assert lengths.tolist() == [len(x) for x in expected] and flat.tolist() == sum(expected, [])
    assert sorted(seen) == sorted(other * 2)


def test_other_rules_take_the_library_s_whole_way(tmp_path):
    settings = json.loads(Tokenizer.from_file(PATH).to_str())
    settings["normalizer"] = {"type": "NFC"}
    path = str(tmp_path / "cased.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(settings, file)
    texts = ["Plain WORDS, 12 of them", "été É"]
    library = Tokenizer.from_file(path)
    words = token_files._WordIds(path)
    assert words.plain is None
    assert [x.tolist() for x in words.ids(pa.array(texts))] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
