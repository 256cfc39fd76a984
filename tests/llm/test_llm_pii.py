import random
import re

import pytest
from corpus import documents
from pyspark.sql import functions as F

from millrace.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), k, kind, m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def base_spans(spark, texts):
    docs = documents(spark, list(enumerate(texts)))
    rows = pii.with_spans(docs).select("doc_id", "pii_spans").collect()
    return {
        r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["pii_spans"] if s["kind"] in PATTERNS] for r in rows
    }


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(2)
    pieces = [
        "a.b@c.d", "x@y", "@", "a@b.c_x@d.e", "é", "🙂", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "007.1.1.1",
        "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "4242424242424242", "12345678901234567890123",
        "+1 (234) 555-3296", "+4915112345678", "+1", "++1 2", " ", "-", ".", "5", "0", "q", "+1 (269) 555-3296 41322646528",
    ]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 12))) for _ in range(600)] + pieces + [None, ""]
    found = base_spans(spark, texts)
    for i, text in enumerate(texts):
        assert found[i] == brute(text), text


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 300_000, "1 " * 150_000, "1" * 300_000, "a.b@c." * 20_000, "+1" * 50_000, "1.2.3." * 30_000]
    found = base_spans(spark, texts)
    assert found[0] == [] and found[2] == []
    assert found[3] == brute(texts[3]) and found[5] == brute(texts[5])


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("my iban is DE89 3704 0044 0532 0130 00 thanks", ["iban"]),
        ("DE89370400440532013000", ["iban"]),
        ("DE88370400440532013000", []),
        ("GB82 WEST 1234 5698 7654 32", ["iban"]),
        ("ssn 078-05-1120", ["ssn"]),
        ("order 078-05-1120", []),
        ("+1 (269) 555-3296 4222222222222 x", ["phone_number", "card_number"]),
        ("4111 1111 1111 1111 +1 234 555 3296", []),
    ],
)
def test_kinds_of_the_method(spark, text, kinds):
    row = pii.with_spans(documents(spark, [(1, text)])).first()
    assert [s["kind"] for s in row["pii_spans"] if s["kind"] not in PATTERNS] == kinds


def test_context_raises_the_score(spark):
    rows = pii.with_spans(documents(spark, [(1, "call +1 234 555 3296"), (2, "xxxx +1 234 555 3296")]))
    scores = {r["doc_id"]: r["pii_spans"][0]["score"] for r in rows.collect()}
    assert scores[1] > scores[2] and max(scores.values()) <= 1


def test_masking(spark):
    rows = pii.without_pii(
        documents(spark, [(1, "é a.b@c.de, 1.2.3.4!"), (2, "none"), (3, None), (4, "+1 (234) 555-3296 4242424242424242")])
    )
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert texts[1] == "é <EMAIL>, <IP>!" and texts[2] == "none" and texts[3] is None
    assert texts[4] == "<PHONE_NUMBER> <CARD_NUMBER>"
    assert rows.columns == documents(spark, []).columns


def test_awkward_and_empty(awkward, empty):
    rows = pii.with_spans(awkward, "kept").collect()
    assert len(rows) == 14 and all(r["kept"] == [] for r in rows)
    assert pii.with_spans(empty).collect() == []
    assert pii.without_pii(awkward).count() == 14


def test_no_python_runs(spark, awkward):
    plan = pii.with_spans(awkward).select(F.size("pii_spans"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    "text,found",
    [
        ("SSN: 078-05-1120, 219-09-9998", ["078-05-1120", "219-09-9998"]),
        ("é🙂 ssn\n078-05-1120\n219-09-9998\n457-55-5462\norder", ["078-05-1120", "219-09-9998", "457-55-5462"]),
        ("078-05-1120 is my SSN", ["078-05-1120"]),
        ("078-05-1120, 219-09-9998 (social security)", ["078-05-1120", "219-09-9998"]),
        ("078-05-1120 and much later, after more than forty signs, ssn", []),
        ("ssn is named more than forty signs before it: the number 078-05-1120", []),
        ("order 078-05-1120, 219-09-9998 shipped", []),
    ],
)
def test_context_reaches_across_matches_and_after(spark, text, found):
    row = pii.with_spans(documents(spark, [(1, text)])).first()
    spans = [s for s in row["pii_spans"] if s["kind"] == "ssn"]
    assert [s["match"] for s in spans] == [text[s["start"] : s["end"]] for s in spans] == found
    masked = pii.without_pii(documents(spark, [(1, text)])).first()["text"]
    assert masked.count("<SSN>") == len(found) and not any(x in masked for x in found)


def test_many_spans_in_one_text_take_linear_time(spark):
    """80,000 addresses, and 20,000 numbers that stand in for failed ones, in one text each."""
    import time

    texts = [
        " ".join(f"é 10.{i % 256}.{i // 256 % 256}.7" for i in range(80_000)),
        ", ".join(f"+1 (269) 555-{1000 + i % 9000} 4222222222222 🙂" for i in range(10_000)),
    ]
    docs = documents(spark, list(enumerate(texts)))
    began = time.time()
    found = {r["doc_id"]: r["text"] for r in pii.without_pii(docs).select("doc_id", "text").collect()}
    assert time.time() - began < 60
    assert found[0] == " ".join(["é <IP>"] * 80_000)
    assert found[1] == ", ".join(["<PHONE_NUMBER> <CARD_NUMBER> 🙂"] * 10_000)


def test_masks_across_the_cuts_of_a_text(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        text = "".join(rng.choice(["é", "🙂", "x ", "1.2.3.4 ", "a@b.cd ", "\n"]) * rng.choice([1, 3, 1500]) for _ in range(9))
        texts.append(text)
    texts += ["1.2.3.4" + "é" * 1017 + "1.2.3.4", "é" * 1024, "1.2.3.4" * 3, "x" * 1023 + " 1.2.3.4"]
    docs = pii.with_spans(documents(spark, list(enumerate(texts))))
    rows = pii.without_pii(documents(spark, list(enumerate(texts)))).select("doc_id", "text").collect()
    spans = {r["doc_id"]: r["pii_spans"] for r in docs.select("doc_id", "pii_spans").collect()}
    for row in rows:
        text, at, out = texts[row["doc_id"]], 0, ""
        for s in spans[row["doc_id"]]:
            if s["start"] >= at:
                out += text[at : s["start"]] + f"<{s['kind'].upper()}>"
            at = max(at, s["end"])
        assert row["text"] == out + text[at:]


def test_folds_before_each_element(spark):
    from millrace.llm.spans import folds_before

    for n in (0, 1, 127, 128, 129, 20_000):
        row = spark.range(1).select(
            folds_before(F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>"), F.lit(0), lambda a, x: a + x).alias("s"),
            folds_before(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: (i * 7919) % 1009), F.lit(0), lambda a, x: F.greatest(a, x)).alias("m"),
        ).first()
        assert row["s"] == [i * (i + 1) // 2 for i in range(n)]
        most, expected = 0, []
        for i in range(n + 1):
            expected.append(most)
            most = max(most, i * 7919 % 1009)
        assert row["m"] == expected


def test_sql_says_the_same_of_contexts(spark, tmp_path):
    """Lists of numbers, words behind a number and cut contexts, on both sides of the comparison."""
    import duckdb
    from compare import duck_rows, spark_rows

    from millrace.llm import queries

    rng = random.Random(12)
    parts = ["078-05-1120", "219-09-9998", "ssn", "SSN:", "social", "order", ", ", " ", "x" * 9, "\n", "é", "a@b.cd", "(insurance)"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    texts += ["078-05-1120" + " " * n + "ssn" for n in (1, 36, 37, 38, 39, 40)]
    texts += ["ssn" + " " * n + "078-05-1120" for n in (1, 36, 37, 38, 39, 40)]
    documents(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = spark_rows(queries.op3_pii(spark, str(tmp_path)))
    assert found == duck_rows(connection, queries.ORACLES["op3_pii"])
    assert sum("ssn" in str(row) for row in found[1]) > 100
