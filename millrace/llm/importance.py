"""Quality selection by importance resampling.

Words and word pairs are hashed into buckets. Two bag-of-buckets models are counted: one of the
target text, documents labelled as good, and one of all text. A document's log weight is the log
ratio of its probability under the two. Adding Gumbel noise to the log weights and taking the k
largest draws k documents without replacement in proportion to their weights. The noise is a hash
of the row, so a rerun draws the same documents.

All documents are counted and scored; only the model, one row per bucket, reaches the driver. The
target is counted on at most TARGET_ROWS labelled documents, whose ids are the one broadcast. The
k-th largest key is found by counting keys in ever finer bins of its range, not by a global sort.

Defined cases: a null text or one without a word has log weight 0 and is never kept nor counted.
Equal rows have equal keys, and rows with the k-th key are all kept. Without labels everything
with a word is kept. A document with several labels counts as good if one of them says so. Texts
are read whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import hashed_words, mixed
from millrace.llm.storage import stored

BUCKET_BITS = 14
TARGET_ROWS = 20_000
BINS = 1024
# Keys that are looked at one by one in the last step of the search for the k-th.
FEW_KEYS = 10_000
SEED = 11


@dataclass(frozen=True)
class Selection:
    """``scored`` has doc_id, n_words, log_weight, key; rows with words and key >= least are kept."""

    scored: DataFrame
    least: float


def _buckets(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs that start at each word but the last."""
    shift = np.uint64(64 - BUCKET_BITS)
    pairs = mixed(words[:-1] * np.uint64(3) + words[1:])
    return (words >> shift).astype(np.int64), (pairs >> shift).astype(np.int64)


def _inner(offsets: np.ndarray, n_words: int) -> np.ndarray:
    """Which pairs lie within one text."""
    inner = np.ones(max(0, n_words - 1), bool)
    cuts = offsets[(offsets > 0) & (offsets < n_words)]
    inner[cuts - 1] = False
    return inner


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, raw, target) counts of ``docs`` (text, is_target); a sum per task, then overall."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BUCKET_BITS
        totals = np.zeros((2, size), np.int64)
        for batch in batches:
            good = np.array(batch.column(1).to_pylist(), bool)
            for first, last, words, offsets in hashed_words(batch.column(0)):
                singles, pairs = _buckets(words)
                inner = _inner(offsets, len(words))
                of_text = np.repeat(good[first:last], np.diff(offsets))
                for row, chosen in ((0, slice(None)), (1, of_text)):
                    totals[row] += np.bincount(singles[chosen], minlength=size)
                totals[0] += np.bincount(pairs[inner], minlength=size)
                totals[1] += np.bincount(pairs[inner & of_text[:-1]], minlength=size)
        names = ["bucket", "raw", "target"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(totals[0]), pa.array(totals[1])], names
        )

    parts = docs.select("text", "is_target").mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log of target over raw probability by bucket, with one added to each count."""
    raw, target = np.ones(1 << BUCKET_BITS), np.ones(1 << BUCKET_BITS)
    for row in counts.collect():
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    if target.sum() == len(target):
        return np.zeros(len(target))
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigher(ratios: np.ndarray) -> Callable[[Column], Column]:
    """A function of a text column that gives struct<n_words, log_weight>."""

    @F.arrow_udf("struct<n_words: bigint, log_weight: double>")
    def weigh(texts: pa.Array) -> pa.Array:
        n_words, weights = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for first, last, words, offsets in hashed_words(texts):
            singles, pairs = _buckets(words)
            running = np.concatenate([[0.0], np.cumsum(ratios[singles])])
            both = np.where(_inner(offsets, len(words)), ratios[pairs], 0.0)
            # A text's pairs start at its words; the pair from its last word is masked.
            paired = np.concatenate([[0.0], np.cumsum(both), [0.0]])
            paired[-1] = paired[-2]
            lo, hi = offsets[:-1], offsets[1:]
            n_words[first:last] = hi - lo
            weights[first:last] = running[hi] - running[lo] + paired[hi] - paired[lo]
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.array(np.round(weights, 6))], ["n_words", "log_weight"]
        )

    return weigh


def kth_largest(values: DataFrame, k: int) -> float:
    """The k-th largest of the double column ``key``, or minus infinity if there are fewer."""
    low, high, n = values.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k > n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0  # keys over the interval that is still searched
    while n > FEW_KEYS and low < high:
        step = (high - low) / BINS
        place = F.least(F.floor((F.col("key") - low) / step), F.lit(BINS - 1))
        inside = values.where(F.col("key").between(low, high)).groupBy(place.alias("bin"))
        bins = inside.agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                low, high, n = row["low"], row["high"], row["n"]
                break
            above += row["n"]
    if low == high:
        return low
    keys = values.where(F.col("key").between(low, high)).select("key").collect()
    return sorted((r["key"] for r in keys), reverse=True)[k - above - 1]


def resampled(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, log_weight, score, kept) of every row of ``docs`` (doc_id, text).

    ``labels`` has doc_id and quality (0 or 1). ``share`` of the documents with words are kept; it
    is the share of good ones among the labelled documents unless it is given. ``score`` is the log
    weight per word or pair, as a probability.
    """
    by_doc = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    if share is None:
        share = by_doc.agg(F.avg("quality")).first()[0]
        share = 1.0 if share is None else float(share)
    chosen = (
        by_doc.where("quality = 1")
        .select(F.col("doc_id").alias("target_id"))
        .orderBy(F.xxhash64("target_id", F.lit(seed)), "target_id")
        .limit(TARGET_ROWS)
    )
    texts = docs.select("doc_id", "text")
    marked = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("target_id"), "left")
    ratios = log_ratios(bucket_counts(marked.select("text", F.col("target_id").isNotNull().alias("is_target"))))
    weigh = weigher(ratios)
    # A uniform number in (0, 1) from the row itself.
    uniform = (F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)) + 0.5) / (1 << 52)
    scored = stored(
        texts.select("doc_id", uniform.alias("u"), weigh(F.col("text")).alias("w")).select(
            "doc_id",
            "w.n_words",
            "w.log_weight",
            (F.col("w.log_weight") - F.log(-F.log("u"))).alias("key"),
        ),
        "weights",
    )
    with_words = scored.where("n_words > 0")
    least = kth_largest(with_words, round(share * with_words.count()))
    per_feature = F.col("log_weight") / F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    return scored.select(
        "doc_id",
        "n_words",
        "log_weight",
        F.round(1 / (1 + F.exp(-per_feature)), 6).alias("score"),
        ((F.col("n_words") > 0) & (F.col("key") >= least)).alias("kept"),
    )
