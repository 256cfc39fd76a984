import math
import random
import re
from collections import Counter

import pytest
from corpus import documents

from millrace.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    bags = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    held = [(doc_id, bag, sum(bag.values())) for doc_id, bag in bags if bag]
    n_all, l_all = len(held), sum(n for *_, n in held)
    holders = Counter(t for _, bag, _ in held for t in bag)
    out = []
    for item_id, text in set(items):
        hits = []
        for doc_id, bag, n in held:
            m = 25 + (75 * n * n_all) // l_all
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * holders[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in terms_of(text)
                if bag[t]
            )
            if score > 0:
                hits.append((-score, doc_id is None, doc_id or 0, doc_id))
        hits.sort(key=lambda h: h[:3])
        out += [(item_id, rank + 1, h[3], -h[0]) for rank, h in enumerate(hits[:top])]
    return sorted(out, key=repr)


def search(spark, docs, items, **settings):
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    rows = lexical_search.ranked(documents(spark, docs), frame, **settings).collect()
    return sorted(map(tuple, rows), key=repr)


def generated(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"{c}{i}" for i, c in enumerate("abcdéß中" * 12)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(size):
        words = rng.choices(vocabulary, weights, k=size)
        return "".join(rng.choice([w, w.upper(), w.title()]) + rng.choice([" ", ", ", "\n", "_", "@", "[x]"]) for w in words)

    docs = [(i, text(rng.randrange(0, 60))) for i in range(n)]
    return docs, [(i, text(rng.randrange(0, 15))) for i in range(25)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    docs, items = generated(seed, 200)
    # Copies make ties, which the id decides.
    docs += [(1000 + i, docs[5][1]) for i in range(30)]
    assert search(spark, docs, items) == brute(docs, items)
    # The same in many shards and lots, and over several passes.
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", 50)
    monkeypatch.setattr(lexical_search, "LOT", 4)
    monkeypatch.setattr(lexical_search, "VOCABULARY", 100)
    assert search(spark, docs, items) == brute(docs, items)
    assert search(spark, docs, items, top=1) == brute(docs, items, top=1)


def test_accumulators_shrink_without_losing_a_document():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, terms = 400, 40
    weights = np.sort(rng.integers(1, 9000, terms))[::-1].astype(np.int64)
    corpus = lexical_search.Corpus(
        n, n * 9, weights, (np.arange(terms) * lexical_search.OWNERS // terms).astype(np.int8), {7: (np.arange(terms), np.ones(terms, np.int64))}
    )
    has = rng.random((n, terms)) < np.linspace(0.02, 0.6, terms)
    impact = rng.integers(1, 900_000, (n, terms))
    exact = (has * impact * weights).sum(axis=1)
    none = pa.array([[]], pa.list_(pa.int64()))
    bundles = pa.table({"shard": [0], "lot": [0], "item": [7], "closed": [False], "rows": none, "ids": none, "scores": none})
    carried = []
    for owner in range(lexical_search.OWNERS):
        own = [np.flatnonzero(has[d] & (corpus.owners == owner)) for d in range(n)]
        postings = pa.table({
            "row": np.arange(n), "doc_id": np.arange(n),
            "terms": pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())),
            "impacts": pa.array([impact[d, x].astype(np.int32) for d, x in enumerate(own)], pa.list_(pa.int32())),
        })
        bundles = lexical_search._stage(corpus, owner, 10)(bundles, postings)
        carried.append(len(bundles["rows"][0]))
    best = sorted(range(n), key=lambda d: (-exact[d], d))[:10]
    assert bundles["ids"][0].as_py() == best
    assert bundles["scores"][0].as_py() == exact[best].tolist()
    assert carried[-2] < n / 2, carried


def test_awkward_rows(spark, awkward, empty):
    docs = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    items = [(1, "the quick fox"), (1, "the quick fox"), (1, "two"), (2, None), (3, ""), (4, "!!!"), (None, "é ÉSS 中文 123"), (5, "absent")]
    frame = spark.createDataFrame([(*row, 1) for row in items], "item_id bigint, text string, rank int")
    rows = sorted(map(tuple, lexical_search.ranked(awkward, frame).collect()), key=repr)
    assert rows == brute(docs, items)
    assert lexical_search.ranked(empty, frame).collect() == []
    assert lexical_search.ranked(awkward, frame.limit(0)).collect() == []
    assert lexical_search.ranked(awkward, frame.where("item_id = 2")).columns == ["item_id", "rank", "doc_id", "score"]
