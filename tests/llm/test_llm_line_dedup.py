import random
from collections import defaultdict

import pytest
from corpus import documents
from pyspark.sql import functions as F

from millrace.llm import line_dedup
from millrace.llm.storage import Scratch

LOWER = str.maketrans(line_dedup.UPPER, line_dedup.UPPER.lower())


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(rows, min_chars=40, min_documents=5):
    """(doc_id, text that stays, lines, dropped) of (doc_id, text) rows."""
    holders = defaultdict(list)
    for doc_id, text in rows:
        for key in {key_of(x) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append(doc_id)
    keeper = {
        key: max((i for i in ids if i is not None), default=None)
        for key, ids in holders.items()
        if len(ids) >= min_documents
    }
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == doc_id]
        out.append((doc_id, None if text is None else "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def found(df, **settings):
    rows = line_dedup.without_shared_lines(df, **settings).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(map(tuple, rows), key=repr)


def generated(seed, n):
    rng = random.Random(seed)
    shared = [f"{w} line number {i} that several documents have in common" for i, w in enumerate("ÀabBCé中z")]
    blanks = ["", " ", "\t", "\x0b \r", " "]
    rows = []
    for _ in range(n):
        lines = []
        for _ in range(rng.randrange(0, 7)):
            line = rng.choice([*shared, "short", "", f"a line of its own {rng.random()} that nobody else has"])
            line = rng.choice([line, line.upper(), line.lower()])
            lines.append(rng.choice(blanks) + line + rng.choice(blanks))
        rows.append((rng.choice([None, *range(n // 2)]), "\n".join(lines)))
    return rows


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_equals_brute_force(spark, batches):
    rows = generated(batches, 150)
    assert found(documents(spark, rows), batches=batches) == brute(rows)


def test_limits_count_code_points_and_documents(spark):
    rows = [(i, "é" * 39 + "\n" + "é" * 40) for i in range(5)] + [(i, "ü" * 40) for i in range(4)]
    assert found(documents(spark, rows)) == brute(rows)
    rows = [(1, "\n".join(["x" * 50] * 6))]  # six lines of one document
    assert found(documents(spark, rows)) == brute(rows)
    rows = [(i, "\n".join(["x" * 50, "own", "x" * 50])) for i in range(5)]
    assert [r[3] for r in found(documents(spark, rows))] == [2, 2, 2, 2, 0]
    assert found(documents(spark, rows), min_chars=3, min_documents=2) == brute(rows, 3, 2)


def test_awkward_rows(spark, awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert found(awkward) == brute(rows)
    kept = line_dedup.without_shared_lines(awkward)
    assert set(awkward.columns) <= set(kept.columns)
    assert found(empty) == []


def test_one_id_for_many_rows_and_long_texts(spark):
    line = "one very common line, which all of the documents here have"
    rows = [(None, f"{line}\nrow {i % 50} of many rows that come without any id at all") for i in range(400)]
    rows += [(7, "\n".join([line, *(f"numbered line {i} of a text with a great many lines" for i in range(20_000)), line]))]
    rows += [(8, "\n".join(f"numbered line {i} of a text with a great many lines" for i in range(20_000)))] * 4
    assert found(documents(spark, rows)) == brute(rows)


def test_runs_are_merged_in_place_and_never_moved(spark):
    rows = [(i, f"a line that is shared by all, long enough\na line of {i // 2} that is shared by two of them") for i in range(40)]
    docs = documents(spark, rows).select("doc_id", F.inline(line_dedup.long_lines(F.col("text"), 20)))
    with Scratch(spark, "test") as scratch:
        runs = line_dedup.LineRuns(scratch, min_documents=5)
        sizes = []
        for low in range(30, -1, -10):
            runs.add(docs.where((F.col("doc_id") >= low) & (F.col("doc_id") < low + 10)))
            sizes.append([name is not None for name in runs.levels])
        # A binary counter: two runs of a level make one of the next.
        assert sizes == [[True], [False, True], [True, True], [False, False, True]]
        counts = {r["documents"] for r in spark.table(runs.runs()[0]).collect()}
        # The common line is counted in the first batch only: it was frequent from then on.
        assert counts == {2, 10}
        assert {r["keeper"] for r in runs.frequent().collect()} == {39}
        run = spark.table(runs.runs()[0])
        plan = run.join(run.select("h1", "h2").where("h1 > 0"), line_dedup.KEY, "left_anti")._jdf.queryExecution().toString()
        assert "Exchange hashpartitioning" not in plan
        runs.close()


def test_a_text_of_very_many_lines_takes_time_in_proportion(spark):
    """The text is hashed once, not once for each of its lines."""
    import time

    text = "\n".join(f"numbered line {i} of one text with a great many lines in it" for i in range(150_000))
    began = time.time()
    assert [r[2:] for r in found(documents(spark, [(1, text)]))] == [(150_000, 0)]
    assert time.time() - began < 60
