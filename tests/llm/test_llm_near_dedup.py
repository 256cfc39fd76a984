import glob
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import PROSE, documents

from millrace.llm.components import components
from millrace.llm.near_dedup import MINIMA, minima_of, near_duplicates, rows_per_band, shingle_sets
from millrace.session import working_root


def brute(rows, size, percent):
    """Set size and smallest reachable id of every document by comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split() if text else []
        if len(words) >= size:
            sets[doc_id] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        else:
            sets[doc_id] = {tuple(words)} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def changed(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(PROSE) + str(rng.randrange(9))
    return words


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_groups_equal_brute_force(spark, size, percent):
    rng = random.Random(size)
    rows = []
    for group in range(12):
        base = [rng.choice(PROSE) + str(rng.randrange(40)) for _ in range(rng.choice([4, 30, 150, 400]))]
        for _ in range(rng.randrange(1, 14)):
            rows.append((rng.randrange(10**6), " ".join(changed(base, rng, rng.randrange(0, 8)))))
    rows = list(dict(rows).items())
    found = {
        r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
        for r in near_duplicates(documents(spark, rows), size, percent).collect()
    }
    expected = brute(rows, size, percent)
    assert {d: x[:2] for d, x in found.items()} == expected
    assert all(kept == (d == component) for d, (_, component, kept) in found.items())


def test_crowded_buckets_equal_brute_force(spark):
    """Copies of one text, from barely to strongly changed: about half of them are linked."""
    rng = random.Random(12)
    base = [rng.choice(PROSE) + str(rng.randrange(40)) for _ in range(140)]
    rows = [(k, " ".join(changed(base, rng, rng.randrange(0, 22)))) for k in range(150)]
    line = " ".join(PROSE[:9])
    rows += [(500 + k, line + " " + " ".join(rng.choice(PROSE) + str(rng.randrange(99)) for _ in range(12))) for k in range(60)]
    found = near_duplicates(documents(spark, rows), 3, 85).collect()
    expected = brute(rows, 3, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert 20 < len({c for _, c in expected.values()}) < 190


def test_chain_of_copies_is_one_group(spark):
    """Each text resembles the next one only; the group's ends have nothing in common."""
    words = [f"w{i}" for i in range(400)]
    rows = [(900 - k, " ".join(words[6 * k : 6 * k + 100])) for k in range(50)]
    found = near_duplicates(documents(spark, rows), 3, 85).collect()
    assert {r["component_id"] for r in found} == {851}


def test_awkward_texts(awkward):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == 14
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    for doc_id in (1, 2, 3):
        assert by_id[doc_id][0]["n_shingles"] == 0 and by_id[doc_id][0]["kept"]
    assert [r["component_id"] for r in by_id[7]] == [6, 6] and not by_id[7][0]["kept"]
    assert by_id[4][0]["n_shingles"] == 1 and by_id[8][0]["n_shingles"] > 20_000
    assert all(r["component_id"] is None and r["kept"] for r in by_id[None])


def test_empty_table(empty):
    assert near_duplicates(empty).collect() == []


def test_band_width_follows_the_threshold():
    for percent in (50, 80, 85, 95):
        r = rows_per_band(percent)
        assert (1 - (percent / 100) ** r) ** (MINIMA // r) <= 1e-6
        assert (1 - (percent / 100) ** (r + 1)) ** (MINIMA // (r + 1)) > 1e-6 or r == MINIMA


def test_minima_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 63, 1000).astype(np.uint64)])
    assert abs((minima_of(a) == minima_of(b)).mean() - 0.6) < 0.15


def test_shingle_sets_do_not_cross_texts():
    sets = list(shingle_sets(pa.array(["a b c", "b c d", "a b c d", "a b", None]), 3))
    assert [len(s) for s in sets] == [1, 1, 2, 1, 0]
    assert set(sets[2].tolist()) == set(sets[0].tolist()) | set(sets[1].tolist())


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]
    edges += [(i, i + 1) for i in range(1000, 1080)] + [(5000, 5000 + i) for i in range(1, 60)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == {x: find(x) for x in root}
    assert len(found) == len(root)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_scratch_tables_are_deleted(spark, awkward):
    near_duplicates(awkward).collect()
    root = working_root(spark).removeprefix("file:")
    assert glob.glob(f"{root}/millrace/llm-near-dedup-*") == []
    assert glob.glob(f"{root}/millrace/llm-sketches-*") != []
