import random

import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe, remembered

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={}
    )


def test_ids_equal_the_library(library):
    rng = random.Random(3)
    pool = "abc  \n\t\r\x0b\x1c\x85\xa0'stvlldmeéßñ0129²½٣!?.,—中文日本한국🙂́ µªº×÷"
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        ids = bpe.encode_text(text, PATH, public_tokenizers.PATTERN)
        assert ids == library.encode_ordinary(text)
        assert bpe.decode_ids(ids, PATH) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, "é" * 5000, "!" * 7000, "thenand" * 2000])
def test_long_pieces(library, text):
    assert bpe.encode_text(text, PATH, public_tokenizers.PATTERN) == library.encode_ordinary(text)


def test_documents_round_trip(spark, small, library, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    for row in bpe.with_ids(docs, PATH, public_tokenizers.PATTERN).collect():
        assert row["ids"] == library.encode_ordinary(row["text"])
        assert bytes(row["decoded"]) == row["text"].encode()


def test_awkward_and_empty(awkward, empty):
    coded = bpe.with_ids(awkward, PATH, public_tokenizers.PATTERN)
    # The input has a column of the same name, which is replaced.
    assert coded.columns == [*(c for c in awkward.columns if c != "ids"), "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == 14
    for row in rows:
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
        assert bool(row["ids"]) == bool(row["text"])
    assert bpe.with_ids(empty, PATH, public_tokenizers.PATTERN).collect() == []


def test_one_python_step_for_both_directions(spark, small):
    from plans_text import plan_text

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    plan = plan_text(bpe.with_ids(docs, PATH, public_tokenizers.PATTERN).select("doc_id", "ids", "decoded"))
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_memory_stays_bounded(monkeypatch, library):
    monkeypatch.setattr(remembered, "REMEMBERED", 10)
    bpe._memory.cache_clear()
    for i in range(100):
        text = f"piece{i % 25} other{i % 7} " + "z" * 200
        assert bpe.encode_text(text, PATH, public_tokenizers.PATTERN) == library.encode_ordinary(text)
        memory = bpe._memory(PATH)
        assert memory.now.words <= 20 and memory.last.words <= 20
    bpe._memory.cache_clear()
