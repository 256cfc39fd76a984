import random

import corpus_pipeline
import public_tokenizers
import tiktoken
from corpus import PROSE, awkward_rows, documents

from millrace.llm import bpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(spark, name, docs, folder):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def fixture(spark, tmp_path, items):
    folder = str(tmp_path)
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontamination", "pii", "byte_bpe",
    ]


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(PROSE) + rng.choice(["", "s", "ed"]) for _ in range(n))
    leak, copy = prose(40), prose(200)
    rows = [(k, prose(120)) for k in range(20)]
    rows += [(30, copy), (31, copy), (32, copy + " more"), (33, prose(60) + " " + leak), (34, "123 !!"), (35, "Привет как дела")]
    rows += [(36, f"{prose(80)} mail me@example.org now")]
    folder = fixture(spark, tmp_path, [(1, leak)])
    docs = documents(spark, rows)

    known = stage(spark, "language_id", docs, folder)
    ids = {r["doc_id"] for r in known.collect()}
    assert 34 not in ids and ids >= set(range(20)) and known.columns == docs.columns
    unique = stage(spark, "near_dedup", docs, folder)
    assert {r["doc_id"] for r in unique.collect()} == {r[0] for r in rows} - {31, 32}
    clean = stage(spark, "decontamination", docs, folder)
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {33}
    masked = {r["doc_id"]: r for r in stage(spark, "pii", docs, folder).collect()}
    assert "me@example.org" not in masked[36]["text"] and "<EMAIL>" in masked[36]["text"]
    assert masked[36]["n_chars"] == len(masked[36]["text"]) and masked[30]["text"] == copy
    coded = stage(spark, "byte_bpe", docs, folder).collect()
    texts = dict(rows)
    assert all(r["decoded"] == texts[r["doc_id"]] and len(r["ids"]) == r["n_tokens"] for r in coded)


def test_stages_take_awkward_rows(spark, awkward, empty, tmp_path):
    folder = fixture(spark, tmp_path, [(1, " ".join(PROSE)), (2, None)])
    counts = {}
    for name, function in corpus_pipeline.STAGES:
        found = function(spark, awkward, folder)
        counts[name] = found.count()
        if name != "byte_bpe":
            assert found.columns == awkward.columns
        assert function(spark, empty, folder).count() == 0
    n = len(awkward_rows())
    assert counts["pii"] == counts["byte_bpe"] == n
    assert counts["near_dedup"] == n - 2  # ids 6 and 7 hold one text three times
    assert counts["decontamination"] == n - 3


def test_run_keeps_what_the_stages_keep(spark, small):
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select(COLUMNS)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 0.5 * len(texts) < len(found) <= len(texts)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(path), special_tokens={}
    )
    assert len({r["decoded"] for r in found.values()}) == len(found)
    for doc_id, row in found.items():
        assert row["ids"] == library.encode_ordinary(row["decoded"])
        assert row["decoded"] == texts[doc_id] or "<" in row["decoded"]


def test_rows_of_one_id_are_decided_apart(spark, tmp_path):
    rng = random.Random(5)
    prose = lambda n: " ".join(f"{rng.choice(PROSE)}{rng.randrange(50)}" for _ in range(n))
    leak, copy = prose(40), prose(80)
    rows = [(None, prose(30) + " " + leak), (None, prose(70)), (7, leak), (7, prose(60)), (8, prose(50))]
    folder = fixture(spark, tmp_path, [(1, leak)])
    clean = {r["text"] for r in stage(spark, "decontamination", documents(spark, rows), folder).collect()}
    assert clean == {text for _, text in rows if leak not in text}

    # A copy without an id goes, other texts without one stay; two texts of one id both stay.
    rows = [(3, copy), (None, copy), (None, rows[1][1]), (None, rows[1][1]), (7, rows[3][1]), (7, rows[4][1]), (9, copy)]
    docs = documents(spark, rows)
    kept = stage(spark, "near_dedup", docs, folder)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [rows[0], rows[2], rows[4], rows[5]], key=str
    )
