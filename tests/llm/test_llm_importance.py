import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from corpus import PROSE, documents

from millrace.llm import importance
from millrace.llm.blocks import hashed_words


def buckets(text):
    """Buckets of words and pairs, one text at a time."""
    for _, _, words, _ in hashed_words(pa.array([text])):
        singles, pairs = importance._buckets(words)
        return len(words), [*singles.tolist(), *pairs.tolist()]
    return 0, []


def test_weights_equal_a_plain_model(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(PROSE, k=rng.randrange(40))) for _ in range(120)] + [None, "", "solo"]
    rows = list(enumerate(texts))
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(buckets(text or "")[1])
        if i < 60 and i % 3 == 0:
            target.update(buckets(text or "")[1])
    size = 1 << importance.BUCKET_BITS
    n_raw, n_target = sum(raw.values()) + size, sum(target.values()) + size
    found = {r["doc_id"]: r for r in importance.resampled(documents(spark, rows), labels).collect()}
    for i, text in rows:
        n, own = buckets(text or "")
        weight = sum(math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in own)
        assert found[i]["n_words"] == n
        assert abs(found[i]["log_weight"] - weight) < 1e-4
    with_words = sum(1 for _, t in rows if t)
    assert sum(r["kept"] for r in found.values()) == round(with_words / 3)
    assert not any(found[i]["kept"] for i, t in rows if not t)


def test_good_text_is_preferred(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = importance.resampled(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    counts = {
        (r["quality"], r["kept"]): r["count"]
        for r in found.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    }
    assert counts[1, True] / (counts[1, True] + counts.get((1, False), 0)) >= 0.97
    assert counts[0, False] / (counts[0, False] + counts.get((0, True), 0)) >= 0.5


def test_kth_largest_equals_sorting(spark, monkeypatch):
    monkeypatch.setattr(importance, "FEW_KEYS", 5)
    monkeypatch.setattr(importance, "BINS", 4)
    rng = random.Random(1)
    values = [rng.gauss(0, 100) ** 3 for _ in range(300)] + [7.5] * 40 + [1e300, -1e300]
    frame = spark.createDataFrame([(v,) for v in values], "key double").cache()
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 3, 50, 150, 160, 341, 342):
        assert importance.kth_largest(frame, k) == ordered[k - 1]
    assert importance.kth_largest(frame, 343) == -math.inf
    assert importance.kth_largest(frame, 0) == math.inf


def test_repeated_runs_and_rows_agree(spark, awkward):
    labels = spark.createDataFrame([(6, 1), (8, 0), (None, 1), (6, None), (99, 1)], "doc_id bigint, quality int")
    runs = [sorted(map(tuple, importance.resampled(awkward, labels).collect()), key=str) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 14
    assert len({r for r in runs[0] if r[0] == 7}) == 1
    assert all(r[2] == 0 and not r[4] for r in runs[0] if r[1] == 0)


def test_empty_tables(spark, empty, awkward):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert importance.resampled(empty, none).collect() == []
    kept = importance.resampled(awkward, none).collect()
    assert all(r["kept"] == (r["n_words"] > 0) and r["log_weight"] == 0 for r in kept)


def test_pairs_stay_in_their_text():
    inner = importance._inner(np.array([0, 0, 2, 2, 5]), 5)
    assert inner.tolist() == [True, False, True, True]
