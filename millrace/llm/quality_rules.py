"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

A text fails if one rule rejects it, so the order of the rules cannot change the verdict, only
the work. On a sample each rule is timed, as the best of some runs less the best of as many runs
that only read the sample, so that the fixed cost of a job does not hide what a rule costs; and it
is counted which rules reject a text together. The first rule is the one with most rejections per
second, the next the one with most of what is left then, and so on. The rules are branches of one
CASE expression, which stops at the first rejection. Everything is column expressions.

Repeated word windows are compared by 64-bit hashes.

Defined cases: a null text counts as empty, has no words, lines or symbols and is rejected for
its length. Equal texts get equal verdicts. Texts are read whole. Without rows to sample the rules
keep their written order. Other columns than the one that is added are not touched.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import let
from millrace.llm.storage import stored

# Rows of the sample that orders the rules, on average.
SAMPLE_ROWS = 2000
# Runs of each timed job.
TRIALS = 3
WINDOW = 3
FEWEST_WORDS = 50
MOST_REPEATED_PERCENT = 50

BLANK = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{BLANK}+"), "")


def _removed(text: Column, regex: str) -> Column:
    """Code points of a text that match a class."""
    return (F.length(text) - F.length(F.regexp_replace(text, regex, ""))).cast("long")


def _repeated(words: Column) -> Column:
    """Words in windows of WINDOW words that occur at least twice, the first one included."""

    def of(hashes: Column) -> Column:
        keyed = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        )

        def repeated(s: Column) -> Column:
            return F.filter(
                s,
                lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            )

        def covered(at: Column) -> Column:
            width = F.transform(
                at, lambda a, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - a, F.lit(WINDOW)))
            )
            return F.aggregate(width, F.lit(0).cast("long"), lambda n, x: n + x)

        positions = let(keyed, lambda s: F.array_sort(F.transform(repeated(s), lambda x: x["at"])))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(positions, covered)).otherwise(
            F.lit(0).cast("long")
        )

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(F.size(words) >= WINDOW, let(hashes, of)).otherwise(F.lit(0).cast("long"))


def word_measures(text: Column) -> Column:
    """struct<n_words, word_chars, n_repeat_words>; the words are split once."""
    return let(
        _words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
        ),
    )


def line_measures(text: Column) -> Column:
    """struct<n_lines, n_dup_lines>: lines with a word, and those equal to an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all base measures in a column ``measures``, in place of one of that name."""
    t = F.coalesce(docs[text], F.lit(""))
    return docs.withColumn(
        "measures",
        let(
            F.struct(word_measures(t).alias("w"), line_measures(t).alias("l")),
            lambda m: F.struct(
                *(m["w"][name].alias(name) for name in ("n_words", "word_chars", "n_repeat_words")),
                *(m["l"][name].alias(name) for name in ("n_lines", "n_dup_lines")),
                _removed(t, SYMBOL).alias("n_symbols"),
            ),
        ),
    )


def base_failed(m: Column) -> Column:
    return (m["n_words"] < FEWEST_WORDS) | (
        100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"]
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the text (never null) and the base measures."""

    name: str
    rejects: Callable[[Column, Column], Column]


RULES = [
    Rule("symbols", lambda t, m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda t, m: (m["n_dup_lines"] >= 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"])),
    Rule("word_length", lambda t, m: ~m["word_chars"].between(2 * m["n_words"], 20 * m["n_words"])),
    Rule("exclamations", lambda t, m: 10 * _removed(t, "!+") > 3 * m["n_words"]),
    Rule("capitals", lambda t, m: 10 * _removed(t, r"\p{Lu}+") > 4 * m["word_chars"]),
    Rule("letters", lambda t, m: 2 * _removed(t, r"\p{L}+") < m["word_chars"]),
]


@dataclass(frozen=True)
class Estimate:
    """Seconds that a rule takes on the sample, and the texts that each set of rules rejects.

    A set is a bit mask over the rules; ``together`` is the same for all rules of one sample and has
    as many entries as the sample has rows at most.
    """

    rule: Rule
    seconds: float
    bit: int
    together: dict[int, int]

    @property
    def share(self) -> float:
        total = sum(self.together.values())
        return sum(n for mask, n in self.together.items() if mask >> self.bit & 1) / total if total else 0.0


def _seconds(sample: DataFrame, value: Column) -> float:
    """The best time of a job that computes a value for each row of the sample."""
    best = float("inf")
    for _ in range(TRIALS):
        began = time.perf_counter()
        sample.agg(F.sum(value.cast("int"))).collect()
        best = min(best, time.perf_counter() - began)
    return best


def estimates(rules: list[Rule], docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and rejections of each rule on a sample of ``docs`` (text).

    The sample is taken before it is measured, so the other texts are not looked at.
    """
    total = docs.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    sample = stored(measured(docs.select("text").sample(share, seed=7)), "sample")
    text, measures = F.coalesce("text", F.lit("")), F.col("measures")
    rejected = [F.coalesce(rule.rejects(text, measures), F.lit(False)) for rule in rules]
    masks = sum((F.when(r, 1 << i).otherwise(0) for i, r in enumerate(rejected)), F.lit(0))
    rows = sample.groupBy(masks.alias("mask")).count().collect()
    together = {row["mask"]: row["count"] for row in rows}
    # What reads the same columns and decides nothing.
    empty = _seconds(sample, (F.octet_length(text) >= 0) & (measures["n_words"] >= 0))
    least = empty / 100
    return [
        Estimate(rule, max(_seconds(sample, r) - empty, least), i, together)
        for i, (rule, r) in enumerate(zip(rules, rejected))
    ]


def ordered(found: list[Estimate]) -> list[Rule]:
    """The rules, each next one by what it rejects of the texts left to it, per second."""
    rest, left = list(found), dict(found[0].together) if found else {}
    result = []
    while rest:
        def gain(e: Estimate) -> float:
            return sum(n for mask, n in left.items() if mask >> e.bit & 1) / e.seconds

        best = max(rest, key=gain)  # of equal ones the first
        result.append(best.rule)
        rest.remove(best)
        left = {mask: n for mask, n in left.items() if not mask >> best.bit & 1}
    return result


def first_failed(rules: list[Rule], text: Column, measures: Column) -> Column:
    """Name of the first rule that rejects, in the given order; null if none does."""
    text, result = F.coalesce(text, F.lit("")), None
    for rule in rules:
        rejected = rule.rejects(text, measures)
        result = F.when(rejected, rule.name) if result is None else result.when(rejected, rule.name)
    return F.lit(None).cast("string") if result is None else result
