import random
import re

import duckdb
from corpus import PROSE, documents

from millrace.llm import decontaminate, queries
from millrace.llm.decontaminate import contained_items, without_contaminated


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    found = {}
    for doc_id, text in docs:
        for item_id, item in items:
            own, there = shingles(item), shingles(text)
            n = len(own & there)
            if own and 100 * n >= 80 * len(own):
                found[doc_id, item_id] = (len(own), n)
    return found


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_pairs_equal_brute_force(spark):
    rng = random.Random(6)
    items = [(k, " ".join(rng.choices(PROSE, k=rng.choice([3, 5, 6, 12, 40, 130])))) for k in range(30)]
    docs = []
    for d in range(80):
        words = rng.choices(PROSE, k=rng.randrange(3, 600))
        for _, text in rng.sample(items, 2):
            passage = text.split()
            for _ in range(rng.randrange(3)):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = passage
        docs.append((d, ", ".join(words).upper() if d % 3 else " ".join(words)))
    docs += [(900 + k, text) for k, text in items]
    found = contained_items(documents(spark, docs), items_of(spark, items)).collect()
    got = {(r["doc_id"], r["item_id"]): (r["n_item_shingles"], r["n_shared"]) for r in found}
    assert got == brute(docs, items) and len(found) == len(got)
    assert any(n < q for q, n in got.values())


def test_long_document_is_searched_whole(spark):
    rng = random.Random(1)
    item = " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))
    text = " ".join(f"v{rng.randrange(10**6)}" for _ in range(40_000)) + " " + item
    assert contained_items(documents(spark, [(1, text)]), items_of(spark, [(5, item)])).count() == 1


def test_shuffled_way_gives_the_same(spark, monkeypatch):
    docs = documents(spark, [(1, " ".join(PROSE)), (2, "x " + " ".join(PROSE[:20])), (3, "other words only")])
    items = items_of(spark, [(1, " ".join(PROSE[3:19])), (2, "x"), (3, None)])
    whole = sorted(map(tuple, contained_items(docs, items).collect()))
    monkeypatch.setattr("millrace.llm.decontaminate.BROADCAST_ROWS", 0)
    assert sorted(map(tuple, contained_items(docs, items).collect())) == whole and len(whole) == 2


def test_awkward_and_empty(spark, awkward, empty):
    items = items_of(spark, [(1, " ".join(PROSE)), (1, " ".join(PROSE)), (2, ""), (3, None), (None, "one")])
    found = sorted(map(tuple, contained_items(awkward, items).collect()), key=str)
    assert [x[:2] for x in found] == [(4, None), (6, 1), (7, 1)]
    assert contained_items(empty, items).collect() == []
    assert contained_items(awkward, items_of(spark, [])).collect() == []
    left = without_contaminated(awkward, items)
    assert left.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(
        str(r["doc_id"]) for r in awkward.collect() if r["doc_id"] not in (4, 6, 7)
    )


def test_short_items_are_found_inside_long_texts(spark, tmp_path):
    rows = [(1, " ".join(PROSE) + " Blue, green zebra " + " ".join(PROSE)), (2, "green zebra"), (3, "zebra blue green")]
    rows += [(4, " ".join(PROSE[:20])), (5, "x"), (6, None), (7, "a blue green zebra")]
    items = [(1, "blue green zebra"), (2, "Zebra!"), (3, " ".join(PROSE[4:12])), (4, "x y"), (5, None), (6, "mild potion near the")]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items_of(spark, items).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op4_decontamination(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == [
        (1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 4, 4), (1, 6, 1, 1), (2, 2, 1, 1), (3, 2, 1, 1),
        (4, 3, 4, 4), (4, 6, 1, 1), (7, 1, 1, 1), (7, 2, 1, 1),
    ]
    left = without_contaminated(docs, items_of(spark, items[:2]))
    assert sorted(r["doc_id"] for r in left.collect()) == [4, 5, 6]
    # The SQL says the same of short items.
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(connection.sql(queries.ORACLES["op4_decontamination"]).fetchall()) == sorted(map(tuple, found))


def test_many_rows_without_an_id_cost_no_more_than_with_one(spark, monkeypatch):
    """Each text meets the items that were found in it, not those found under its id."""
    rng = random.Random(3)
    items = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))) for k in range(40)]
    rows = [(None, f"row {i} has words of its own and then {items[i % 40][1]}") for i in range(400)]
    rows += [(7, text) for _, text in rows[:100]] + [(None, rows[0][1])] * 50
    docs = documents(spark, rows)
    checked = []
    plain = decontaminate.stored

    def counted(df, label):
        result = plain(df, label)
        if label == "candidates":
            checked.append(result.count())
        return result

    monkeypatch.setattr(decontaminate, "stored", counted)
    found = {tuple(r)[:2] for r in contained_items(docs, items_of(spark, items)).collect()}
    assert found == {(i, k) for i in (None, 7) for k in range(40)} and checked == [500]
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert {tuple(r)[:2] for r in contained_items(docs, items_of(spark, items)).collect()} == found
