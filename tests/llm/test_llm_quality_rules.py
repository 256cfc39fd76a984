import random
import re
from collections import Counter

from corpus import documents
from pyspark.sql import functions as F

from millrace.llm import quality_rules as Q

BLANKS = r"[\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(BLANKS, text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if re.sub(BLANKS, "", x)]
    return (
        len(words), sum(map(len, words)), len(repeated), len(lines), len(lines) - len(set(lines)),
        len(re.findall(r"[#*$%&|<>]", text)),
    )


def test_measures_equal_brute_force(spark):
    rng = random.Random(9)
    pool = ["a", "b", "c", "é#", "🙂", "x%", "\n", "\n", " ", "\t", "\x0b", "\xa0", "a b c", "\x1c"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", ""]) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [None, "", " ", "a", "a a", "a a a", "a a a a", "a b c a b c", "\n\n", "x\nx\nx"]
    rows = Q.measured(documents(spark, list(enumerate(texts)))).select("doc_id", "measures").collect()
    for row in rows:
        assert tuple(row["measures"]) == brute(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_verdict_does_not_depend_on_the_order(spark, small):
    texts = spark.read.parquet(f"{small}/documents.parquet")
    found = Q.estimates(Q.RULES, texts)
    docs = Q.measured(texts)
    assert len(found) == len(Q.RULES) and all(0 <= e.share <= 1 and e.seconds > 0 for e in found)
    rules = Q.ordered(found)
    ways = [rules, rules[::-1], Q.RULES]
    kept = docs.select(*(Q.first_failed(w, F.col("text"), F.col("measures")).isNull().alias(f"k{i}") for i, w in enumerate(ways)))
    for row in kept.collect():
        assert len(set(row)) == 1


def test_order_is_by_rejections_per_second():
    rules = [Q.Rule(name, None) for name in "abc"]
    together = {0b001: 50, 0b010: 20, 0: 30}
    found = [Q.Estimate(rule, cost, i, together) for i, (rule, cost) in enumerate(zip(rules, (1.0, 0.1, 1.0)))]
    assert [e.share for e in found] == [0.5, 0.2, 0.0]
    assert [r.name for r in Q.ordered(found)] == ["b", "a", "c"]
    assert Q.ordered([]) == []


def test_order_counts_what_earlier_rules_left():
    """Of two rules that reject the same texts, the second one has little left to do."""
    rules = [Q.Rule(name, None) for name in "abc"]
    together = {0b011: 50, 0b001: 5, 0b100: 10, 0: 35}
    found = [Q.Estimate(rule, 1.0, i, together) for i, rule in enumerate(rules)]
    assert [r.name for r in Q.ordered(found)] == ["a", "c", "b"]


def test_cost_is_told_apart_from_that_of_a_job(spark):
    """A comparison of two stored numbers is far cheaper than many passes over the text."""

    def dear(t, m):
        passes = [F.length(F.regexp_replace(t, f"[aeiou]{{{k}}}x?", "")) for k in range(1, 9)]
        return sum(passes) < 0

    rules = [Q.Rule("cheap", lambda t, m: m["n_words"] < 0), Q.Rule("dear", dear)]
    docs = documents(spark, [(i, f"some words of a text that goes on {i} " * 40) for i in range(1500)])
    cheap, costly = Q.estimates(rules, docs)
    assert costly.seconds > 3 * cheap.seconds > 0


def test_first_failed_names_a_rule(spark):
    docs = Q.measured(documents(spark, [(1, "THE BIG DOG RAN " * 20), (2, "the big dog ran home today, " * 20), (3, "## $$ " * 40)]))
    names = {
        r["doc_id"]: r["f"]
        for r in docs.select("doc_id", Q.first_failed(Q.RULES, F.col("text"), F.col("measures")).alias("f")).collect()
    }
    assert names == {1: "capitals", 2: None, 3: "symbols"}


def test_awkward_and_empty(awkward, empty):
    rows = Q.measured(awkward).select("doc_id", "text", "measures", Q.base_failed(F.col("measures")).alias("f")).collect()
    assert len(rows) == 14
    for row in rows:
        assert tuple(row["measures"]) == brute(row["text"])
        assert row["f"] == (row["doc_id"] != 8)
    measured = Q.measured(empty)
    assert measured.collect() == []
    assert [e.share for e in Q.estimates(Q.RULES, empty)] == [0.0] * len(Q.RULES)
    assert awkward.select(Q.first_failed([], F.col("text"), F.lit(None))).count() == 14
