import hashlib
import math

import numpy as np
import pytest

from millrace.llm import vector_codes
from millrace.llm.vector_codes import Codebooks, with_label_error

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, target int"


def table(spark, rows):
    return spark.createDataFrame([(*row, "extra", 1) for row in rows], SCHEMA)


def brute(rows, rounds=4):
    """The same in plain Python integers; rows of (vec_id, vector, label)."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // 4
    parts = [[v[p * size : (p + 1) * size] for _, v, _ in kept] for p in range(4)]
    books = [[list(x) for x in parts[p][:256]] for p in range(4)]

    def assign(p):
        found = []
        for x in parts[p]:
            d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
            found.append((d.index(min(d)), min(d)))
        return found

    for _ in range(rounds):
        for p in range(4):
            members = {}
            for x, (e, _) in zip(parts[p], assign(p)):
                members.setdefault(e, []).append(x)
            for e, xs in members.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    coded = list(zip(*(assign(p) for p in range(4))))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = {}
    for (_, _, label), own in zip(kept, coded):
        errors[label] = errors.get(label, 0) + sum(d for _, d in own)
    out = [
        (i, "".join(f"{e:02x}" for e, _ in own), sum(d for _, d in own), errors[label])
        for (i, _, label), own in zip(kept, coded)
    ]
    return sorted(out, key=repr), digest


def found(df):
    coded, books = vector_codes.vector_codes(df)
    rows = with_label_error(coded).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, rows), key=repr), books.digest() if books else None


@pytest.mark.parametrize("seed", range(2))
def test_equals_plain_rounds(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (12, 8))
    rows = [
        (int(i), (centres[i % 12] + rng.normal(0, 0.05, 8)).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(600)
    ]
    rows += [(1000 + i, rows[0][1], 1) for i in range(200)]  # copies
    rows += [(None, rows[1][1], None), (3, rows[2][1], 4), (3, rows[2][1], 4)]
    assert found(table(spark, rows)) == brute(rows)


def test_rows_that_cannot_be_coded_are_dropped(spark):
    good = [(i, [0.5 * i, -0.25, 1.0, i / 3], 1) for i in range(5)]
    bad = [(9, None, 1), (10, [1.0, None, 1.0, 1.0], 1), (11, [float("nan")] * 4, 1), (12, [1.0, float("inf"), 0.0, 0.0], 1), (13, [], 1)]
    assert found(table(spark, good + bad)) == brute(good)
    assert found(table(spark, good + [(20, [1.0] * 8, 1)])) == brute(good)
    assert found(table(spark, bad)) == ([], None)
    assert found(table(spark, [])) == ([], None)
    assert found(table(spark, [(1, [1.0, 2.0, 3.0], 1)])) == ([], None)


def test_ties_go_to_the_lower_index():
    books = Codebooks(np.array([[[0, 0], [2, 0], [2, 0]]], np.int64))
    index, distance = books.nearest(0, np.array([[1, 0], [2, 0], [9, 9]], np.int64))
    assert index.tolist() == [0, 1, 1]
    assert distance.tolist() == [1, 0, 130]


def test_large_components_are_exact_or_held_to_the_bound(spark):
    rng = np.random.default_rng(3)
    parts = rng.integers(-(1 << 28), 1 << 28, (300, 16))
    book = rng.integers(-(1 << 28), 1 << 28, (1, 50, 16))
    index, distance = Codebooks(book).nearest(0, parts)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)) for e in book[0]] for x in parts]
    assert distance.tolist() == [min(d) for d in exact]
    assert index.tolist() == [d.index(min(d)) for d in exact]
    rows = [(1, [3.0e38, -3.0e38, 1.0, 2.0], 1), (2, [0.0, 0.0, 1.0, 2.0], 1)]
    coded, _ = found(table(spark, rows))
    assert [r[2] for r in coded] == [0, 0]


def test_only_parts_that_change_their_entry_are_shuffled(spark, monkeypatch):
    moved = []
    plain = vector_codes.Members._moved

    def counted(self, assigned):
        moved.append(assigned.count())
        return plain(self, assigned)

    monkeypatch.setattr(vector_codes.Members, "_moved", counted)
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 0.2, 16).tolist(), 1) for i in range(1000)]
    found(table(spark, rows))
    assert moved[0] == 4000
    assert all(n < 2000 for n in moved[1:]), moved
