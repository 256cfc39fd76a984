import math
import zlib

import pyarrow as pa
import pytest
from corpus import documents

from millrace.llm import language, queries


@pytest.fixture(scope="module")
def model(spark, small):
    return language.train(language.labelled_sample(spark.read.parquet(f"{small}/documents.parquet")))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in queries.op1_language_id(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()
    assert len(found) == len(rows)
    assert all(found[r[0]]["held_out"] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if found[r["doc_id"]]["held_out"]]
    right = sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert right / len(held) >= 0.98
    assert sum(found[r["doc_id"]]["accepted"] for r in rows) / len(rows) >= 0.99


def test_awkward_texts(model, awkward):
    identify = language.language_of(model)
    rows = awkward.select("doc_id", "text", identify("text").alias("l")).collect()
    assert len(rows) == 14
    for row in rows:
        letters = row["text"] is not None and any(c.isalpha() for c in row["text"])
        assert (row["l"]["lang"] == "und") == (not letters)
        assert 0 <= row["l"]["score"] <= 1
        assert letters or not row["l"]["accepted"]


def test_equal_texts_and_blocks_agree(model, monkeypatch):
    text = "the thing that and with for " * 500
    batch = pa.array([text, None, "und", text, "x"])
    whole = language.predict(model, batch).to_pylist()
    assert whole[0] == whole[3]
    monkeypatch.setattr(language, "SUM_BYTES", 1000)
    assert language.predict(model, batch).to_pylist() == whole


def plain_forward(model, text):
    """Language and score of a text, bucket by bucket in plain Python."""
    data = (text or "").encode()
    total = [0.0] * len(model.labels)
    known = [0.0] * len(model.labels)
    letters = 0
    lower = [b | 0x20 if 65 <= b <= 90 or 97 <= b <= 122 else b if b >= 0x80 else 0 for b in data] + [0] * 3
    for i in range(len(data)):
        if not lower[i]:
            continue
        letters += 1
        run = []
        for b in lower[i : i + 4]:
            if not b:
                break
            run.append(b)
        run += [0] * (4 - len(run))
        for order in (2, 3, 4):
            gram = sum(b << (8 * k) for k, b in enumerate(run[:order]))
            if order > 2:
                gram ^= gram >> 15
            bucket = (gram * int(language._ORDERS[order - 2]) & 0xFFFFFFFF) >> (32 - language.BUCKET_BITS)
            for k in range(len(model.labels)):
                total[k] += float(model.logits[bucket][k])
                known[k] += float(model.likelihood[bucket][k])
    if not letters or not any(map(str.isalpha, text)):
        return "und", 0.0
    z = [(t / (3 * letters) + float(b)) / model.temperature for t, b in zip(total, model.bias)]
    e = [math.exp(x - max(z)) for x in z]
    weight = letters / (1 + letters / language.TELLING_LETTERS)
    line = [weight * max(known) / (3 * letters), weight, 1.0]
    inside = 1 / (1 + math.exp(-max(-50, min(50, sum(a * float(b) for a, b in zip(line, model.known))))))
    best = max(range(len(e)), key=e.__getitem__)
    return model.labels[best], e[best] / sum(e) * inside


def test_prediction_equals_a_plain_forward_pass(model, spark, small):
    texts = [r[0] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(60).collect()]
    texts += [None, "", "a", "É", "12 ½ !", "中文 text", "x" * 3000, "The\tquick\nbrown", "ab-cd_ef"]
    for text, row in zip(texts, language.predict(model, pa.array(texts, pa.string())).to_pylist()):
        lang, score = plain_forward(model, text)
        assert row["lang"] == lang, text
        assert row["score"] == pytest.approx(score, abs=2e-6)
        assert row["accepted"] == (lang != "und" and score >= model.threshold) or abs(score - model.threshold) < 1e-9


def test_memory_follows_a_group_and_not_the_batch(model):
    import tracemalloc

    texts = pa.array(["the thing that and with for " * 100] * 4000)  # 11 MB
    language.predict(model, texts.slice(0, 10))
    tracemalloc.start()
    language.predict(model, texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6, most


def test_other_scripts_are_rejected(model):
    found = language.predict(model, pa.array(["Привет как твои дела мой друг", "你好世界"])).to_pylist()
    assert not any(row["accepted"] for row in found)


def test_empty_tables(spark, empty, model):
    assert language.labelled_sample(empty) == []
    untrained = language.train([])
    assert language.predict(untrained, pa.array(["abc"])).to_pylist()[0]["lang"] == "und"
    assert empty.select(language.language_of(model)("text")).collect() == []


def test_sample_is_bounded_and_balanced(spark, small):
    rows = language.labelled_sample(spark.read.parquet(f"{small}/documents.parquet"), limit=40)
    assert 20 <= len(rows) <= 40
    assert len({lang for _, lang in rows}) == 4


# Articles of a declaration in languages that no table holds, source code and junk words.
UNLEARNED = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "def main(args): for i in range(10): x = foo.bar(i); print(json.dumps(x, indent=4)); import numpy as np",
    "xqzk vbwpf jjkq zzxw qqpl mnbv wxyz kjhg fdsq plok wqzx vvbn",
]


def labelled(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: r["doc_id"]) if r["text"] and r["lang"]]


def test_latin_texts_of_no_learned_language_are_rejected(spark, model):
    assert not any(r["accepted"] for r in language.predict(model, pa.array(UNLEARNED)).to_pylist())
    texts = [t for t, _ in labelled(spark, "/root/testdata/sf0.01") if any(map(str.isalpha, t))]
    clean = language.predict(model, pa.array(texts)).to_pylist()
    assert sum(r["accepted"] for r in clean) >= 0.98 * len(clean)


@pytest.mark.parametrize("left_out", [["de"], ["en"], ["es"], ["fr"], ["de", "es", "fr"]])
def test_left_out_languages_are_rejected(spark, left_out):
    rows = labelled(spark, "/root/testdata/sf0.01")
    model = language.train([r for r in rows[:500] if r[1] not in left_out])
    for out, share in ((True, 0.03), (False, 0.98)):
        texts = [t for t, lang in rows[500:] if (lang in left_out) == out and len(t) >= 50]
        found = [r["accepted"] for r in language.predict(model, pa.array(texts)).to_pylist()]
        assert sum(found) <= share * len(found) if out else sum(found) >= share * len(found)
    assert not any(r["accepted"] for r in language.predict(model, pa.array(UNLEARNED)).to_pylist())


def test_copies_do_not_fill_the_sample(spark):
    for k in range(4):  # whatever place the hash of a copied text has
        rows = [(i, f"copied text {k}", "en") for i in range(300)]
        rows += [(1000 + i, f"en {k} number {i}", "en") for i in range(60)]
        rows += [(2000 + i, f"de {k} number {i}", "de") for i in range(400)]
        rows += [(3000, f"the only one {k}", "fr"), (3001, f"the only one {k}", "fr")]
        sample = language.labelled_sample(documents(spark, rows), limit=60)
        assert len(set(sample)) == len(sample) <= 60
        assert [sum(lang == x for _, lang in sample) for x in ("de", "en", "fr")] == [20, 20, 1]
    many = [(i, f"text {i}", f"x{i % 9}") for i in range(90)]
    assert len({lang for _, lang in language.labelled_sample(documents(spark, many), limit=4)}) == 9
