"""Ranked lexical search of all items over all documents, by pipelined term partitioning.

Terms are runs of ASCII letters, digits and any character beyond ASCII; A-Z count as a-z. A
document's score for an item adds, for every term of the item (repeats included),

    w * ((1000000000 * tf) div (1000 * tf + 8 * m)),  w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 25 + (75 * n * N) div L,

in 64-bit integers, with N documents that have a term, L terms in all of them, n in the document.

1. Every text is read once. Of each document its number of terms and the occurrences of the items'
   terms are stored.
2. The terms are dealt to OWNERS, from the heaviest weight to the lightest, so that each owner has
   about as many postings; an owner holds its postings in shards of documents of bounded size.
3. An item's bundle, one per shard, visits the owners in turn (cogroup by shard). It carries a
   sparse accumulator: the documents met so far and their scores. Each owner adds the integer
   contributions of its terms to it. A document leaves the accumulator when all that the later
   owners could add cannot lift it to the ``top``-th score of the shard, and no new ones enter when
   the later owners alone cannot reach that score; both bounds are exact, so no result is lost.
4. The last owner selects the best of the shard, and a ranked window those of the item.

The items' vocabulary is sent to every task; it is bounded by VOCABULARY, and a catalog with more
terms is searched in several passes. Items beyond LOT are searched side by side in lots, so that
neither a shard's postings nor its bundles grow with the input. A term is known by 64 bits of hash.

Defined cases: a text that is null or without terms matches nothing and counts only as no
document. Every row is a document, equal doc_ids or not; a null doc_id sorts last among equal
scores. Rows of one item_id with different texts are items of their own, equal rows are one item.
Other columns play no part. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import hashed_words
from millrace.llm.storage import stored

TOP = 10
OWNERS = 4
# Term occurrences of the items that one pass looks for.
VOCABULARY = 200_000
# Items whose bundles meet in one group.
LOT = 512
# Postings of one owner in one shard, on average.
SHARD_POSTINGS = 250_000

# More than any term contributes per unit of weight.
MOST_IMPACT = 1_000_000
# Stands for a null doc_id inside accumulators, and sorts last.
NO_ID = (1 << 63) - 1

_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

Batches = Iterator[pa.RecordBatch]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _spread(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the length of each list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), lengths.astype(np.int64)


def _item_terms(batches: Batches) -> Batches:
    for batch in batches:
        for first, last, words, bounds in hashed_words(batch.column("text"), _BETWEEN):
            part = batch.slice(first, last - first)
            terms = _lists(words.view(np.int64), np.diff(bounds))
            yield pa.RecordBatch.from_arrays([part.column("item_id"), terms], ["item_id", "terms"])


def _postings(vocabulary: np.ndarray) -> Callable[[Batches], Batches]:
    """Number of terms of every document, and the vocabulary's terms in it with their counts."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            for first, last, words, bounds in hashed_words(batch.column("text"), _BETWEEN):
                part = batch.slice(first, last - first)
                sizes = np.diff(bounds)
                at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                known = vocabulary[at] == words
                owner = np.repeat(np.arange(last - first), sizes)[known]
                pairs, times = np.unique(owner * len(vocabulary) + at[known], return_counts=True)
                rows, terms = np.divmod(pairs, len(vocabulary))
                counts = np.bincount(rows, minlength=last - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes.astype(np.int64)),
                        _lists(terms.astype(np.int32), counts),
                        _lists(times.astype(np.int32), counts),
                    ],
                    ["doc_id", "n", "terms", "times"],
                )

    return step


@dataclass(frozen=True)
class Corpus:
    """What one pass knows of the corpus and of its items; bounded by the items' vocabulary."""

    documents: int
    terms: int
    weights: np.ndarray  # of each term of the vocabulary
    owners: np.ndarray  # the owner of each
    items: dict[int, tuple[np.ndarray, np.ndarray]]  # terms of an item and how often it has them

    def share(self, item: int, owner: int) -> tuple[np.ndarray, np.ndarray]:
        """The item's terms at an owner, and their weights times repeats."""
        terms, times = self.items[item]
        own = self.owners[terms] == owner
        return terms[own], self.weights[terms[own]] * times[own]

    def most_after(self, item: int, owner: int) -> int:
        """More than what all later owners can add to a score."""
        terms, times = self.items[item]
        later = self.owners[terms] > owner
        return int((self.weights[terms[later]] * times[later]).sum()) * MOST_IMPACT


def _weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def _owners(weights: np.ndarray, holders: np.ndarray) -> np.ndarray:
    """Owners by descending weight, each with about the same number of postings."""
    order = np.argsort(-weights, kind="stable")
    before = np.cumsum(holders[order]) - holders[order]
    owners = np.zeros(len(weights), np.int8)
    owners[order] = np.minimum(before * OWNERS // max(1, int(holders.sum())), OWNERS - 1)
    return owners


def _owned(corpus: Corpus, owner: int) -> Callable[[Batches], Batches]:
    """The postings of one owner, with the impact of each."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            terms, sizes = _spread(batch.column("terms"))
            times = _spread(batch.column("times"))[0].astype(np.int64)
            n = batch.column("n").to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            own = corpus.owners[terms] == owner
            row, terms, times = row[own], terms[own], times[own]
            m = 25 + (75 * n * corpus.documents) // max(1, corpus.terms)
            impact = (1_000_000_000 * times) // (1000 * times + 8 * m[row])
            counts = np.bincount(row, minlength=batch.num_rows)
            held = pa.array(counts > 0)
            columns = {name: batch.column(name) for name in ("shard", "row", "doc_id")}
            columns |= {"terms": _lists(terms, counts), "impacts": _lists(impact.astype(np.int32), counts)}
            yield pa.RecordBatch.from_pydict(columns).filter(held)

    return step


OWNED = "shard int, row bigint, doc_id bigint, terms array<int>, impacts array<int>"
BUNDLE = "shard int, lot int, item bigint, closed boolean, rows array<bigint>, ids array<bigint>, scores array<bigint>"


class _Shard:
    """One owner's postings of one shard, by term."""

    def __init__(self, postings: pa.Table):
        postings = postings.sort_by("row")
        self.rows = postings.column("row").to_numpy()
        self.ids = postings.column("doc_id").fill_null(NO_ID).to_numpy()
        terms, sizes = _spread(postings.column("terms"))
        order = np.argsort(terms, kind="stable")
        self.terms = terms[order]
        self.document = np.repeat(np.arange(len(self.rows)), sizes)[order]
        self.impact = _spread(postings.column("impacts"))[0][order].astype(np.int64)

    def contributions(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the terms add to every document of the shard."""
        added = np.zeros(len(self.rows), np.int64)
        first = np.searchsorted(self.terms, terms, "left")
        last = np.searchsorted(self.terms, terms, "right")
        for lo, hi, weight in zip(first.tolist(), last.tolist(), weights.tolist()):
            # A document has a term once, so no index repeats.
            added[self.document[lo:hi]] += weight * self.impact[lo:hi]
        return added


def _visited(
    shard: _Shard, added: np.ndarray, closed: bool, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An accumulator with the contributions of an owner; new documents only if it is not closed."""
    if not len(shard.rows):
        return rows, ids, scores
    at = np.minimum(np.searchsorted(shard.rows, rows), len(shard.rows) - 1)
    met = shard.rows[at] == rows
    scores = scores.copy()
    scores[met] += added[at[met]]
    if closed:
        return rows, ids, scores
    added[at[met]] = 0
    new = np.flatnonzero(added)
    joined = ((rows, shard.rows[new]), (ids, shard.ids[new]), (scores, added[new]))
    return tuple(np.concatenate(pair) for pair in joined)


def _stage(corpus: Corpus, owner: int, top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One owner's visit: all bundles of a shard and lot meet the owner's postings of the shard."""

    def visit(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        shard = _Shard(postings)
        columns = [_spread(bundles.column(name)) for name in ("rows", "ids", "scores")]
        ends = np.cumsum(columns[0][1])
        closed = bundles.column("closed").to_pylist()
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i, item in enumerate(bundles.column("item").to_pylist()):
            part = slice(ends[i] - columns[0][1][i], ends[i])
            carried = [values[part] for values, _ in columns]
            added = shard.contributions(*corpus.share(item, owner))
            rows, ids, scores = _visited(shard, added, closed[i], *carried)
            later = corpus.most_after(item, owner)
            if len(scores) > top:
                least = np.partition(scores, -top)[-top]
                keep = scores + later >= least
                closed[i] = bool(closed[i] or later < least)
                rows, ids, scores = rows[keep], ids[keep], scores[keep]
            if owner == OWNERS - 1:
                best = np.lexsort((ids, -scores))[:top]
                rows, ids, scores = rows[best], ids[best], scores[best]
            out.append((rows, ids, scores))
        sizes = np.array([len(x[0]) for x in out], np.int64)
        lists = [_lists(np.concatenate([x[k] for x in out] or [np.zeros(0, np.int64)]), sizes) for k in range(3)]
        kept = [bundles.column(name) for name in ("shard", "lot", "item")]
        names = ["shard", "lot", "item", "closed", "rows", "ids", "scores"]
        return pa.Table.from_arrays([*kept, pa.array(closed, pa.bool_()), *lists], names=names)

    return visit


def _one_pass(documents: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """Rankings of items whose terms fit one vocabulary; items have item, item_id, terms, lot."""
    grouped = items.select("item", F.explode("terms").alias("term")).groupBy("item", "term").count().collect()
    vocabulary = np.unique(np.array([r["term"] for r in grouped], np.int64).view(np.uint64))
    found = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _postings(vocabulary), "doc_id bigint, n bigint, terms array<int>, times array<int>"
    )
    postings = stored(found.withColumn("row", F.monotonically_increasing_id()), "postings")
    totals = postings.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.sum(F.size("terms"))).first()
    n_documents, n_terms, n_postings = (int(x or 0) for x in totals)
    holders = np.zeros(len(vocabulary), np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[row["term"]] = row["count"]
    weights = np.array([_weight(n_documents, int(df)) for df in holders], np.int64)
    terms_of: dict[int, list[tuple[int, int]]] = {}
    for row in grouped:
        at = int(np.searchsorted(vocabulary, np.uint64(row["term"] % (1 << 64))))
        terms_of.setdefault(row["item"], []).append((at, row["count"]))
    by_item = {k: tuple(np.array(v, np.int64).T) for k, v in terms_of.items()}
    corpus = Corpus(n_documents, n_terms, weights, _owners(weights, holders), by_item)

    shards = max(1, -(-n_postings // (OWNERS * SHARD_POSTINGS)))
    dealt = postings.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    lots = -(-len(by_item) // LOT)
    empty = F.array().cast("array<bigint>")
    bundles = items.where(F.size("terms") > 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("item"), F.lit(lots)).cast("int").alias("lot"),
        "item",
        F.lit(False).alias("closed"),
        *[empty.alias(name) for name in ("rows", "ids", "scores")],
    )
    for owner in range(OWNERS):
        owned = dealt.mapInArrow(_owned(corpus, owner), OWNED)
        owned = owned.select(F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"), "*")
        pairs = bundles.groupBy("shard", "lot").cogroup(owned.groupBy("shard", "lot"))
        bundles = pairs.applyInArrow(_stage(corpus, owner, top), BUNDLE)
    return bundles.select("item", F.explode(F.arrays_zip("ids", "scores")).alias("hit")).select(
        "item",
        F.nullif(F.col("hit.ids"), F.lit(NO_ID)).alias("doc_id"),
        F.col("hit.scores").alias("score"),
    )


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item with a score above 0."""
    texts = items.select("item_id", "text").dropDuplicates()
    schema = f"item_id {dict(items.dtypes)['item_id']}, terms array<bigint>"
    queries = stored(texts.mapInArrow(_item_terms, schema).withColumn("item", F.monotonically_increasing_id()), "items")
    occurrences = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = -(-occurrences // VOCABULARY)
    if not passes:
        return queries.select("item_id", F.lit(0).alias("rank"), *[F.lit(0).cast("bigint").alias(c) for c in ("doc_id", "score")]).limit(0)
    parts = [queries.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i) for i in range(passes)]
    hits = reduce(DataFrame.unionByName, [_one_pass(documents, part, top) for part in parts])
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
