"""Benchmark items inside documents: size-partitioned MinHash containment search.

An item is the set of its distinct five-word shingles; a document contains it if at least 80 % of
them are shingles of the document. Items are partitioned by the size of their sets, in powers of
two. An item's signature holds the smallest hash values of its set, as many as the largest set of
its partition may lack, plus one. By counting, a document that contains the item has one of them,
whatever the document's length, so the search misses nothing. (A signature of the long document
would: one of 256 minima finds a 30-shingle item in a document of 20,000 words with a chance of
about a third.) Candidates are then verified on the shingles themselves.

The signatures are broadcast only if there are at most BROADCAST_ROWS of them; more are joined by
a shuffle on the hash, whose frequent values adaptive execution splits. The same bound holds for
the candidates, by which the texts are filtered before they move to be verified; more of them are
joined with all texts.

Words are runs of letters and digits, in lower case. Defined cases: a null text or one without a
word has no shingles; such an item is found nowhere. With fewer words than a shingle, all words
are the one shingle; for such items, documents are also searched by runs of as many words, for the
lengths that occur among the items. Rows of one item id, or of one document id, are each searched; a pair of ids
is reported once, with its largest containment. Rows without a document id are reported under
null. Texts are read whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import let
from millrace.llm.storage import stored

SHINGLE_WORDS = 5
CONTAINED_PERCENT = 80
BROADCAST_ROWS = 200_000


def shingles(text: Column, size: int = SHINGLE_WORDS, lengths: Sequence[int] = ()) -> Column:
    """The word shingles of a text in order, repeated ones included.

    After them come the runs of as many words as each of ``lengths`` says.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    none = F.array().cast("array<string>")

    def runs(w: Column, length: int, least: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - length + 1, F.lit(1)))
        rolled = F.transform(starts, lambda i: F.array_join(F.slice(w, i, length), " "))
        return F.when(F.size(w) >= least, rolled).otherwise(none)

    def of(w: Column) -> Column:
        own = runs(w, size, 1)
        return F.concat(own, *(runs(w, n, n) for n in lengths)) if lengths else own

    return let(words, of)


def _signature(own: Column, percent: int) -> Column:
    """The smallest hash values of a set, by the largest size of its partition."""
    largest = F.pow(F.lit(2.0), F.ceil(F.log2(F.size(own))))
    wanted = F.floor(largest * (100 - percent) / 100).cast("int") + 1
    return F.slice(F.array_sort(F.transform(own, lambda s: F.xxhash64(s))), 1, wanted)


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    percent: int = CONTAINED_PERCENT,
    size: int = SHINGLE_WORDS,
    short_inside: bool = False,
) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared) of every document that contains an item.

    ``docs`` has doc_id and text, ``items`` item_id and text. With ``short_inside`` an item of fewer
    words than a shingle is searched inside longer documents too; without, it is found only in a
    document of exactly its words.
    """
    catalog = stored(
        items.select("item_id", F.array_distinct(shingles(items["text"], size)).alias("own"))
        .where(F.size("own") > 0)
        .withColumn("row", F.monotonically_increasing_id()),
        "items",
    )
    lengths: list[int] = []
    if short_inside:
        n_words = F.size(F.split(F.col("own")[0], " "))
        found = catalog.where(F.size("own") == 1).select(n_words.alias("n")).where(F.col("n") < size)
        lengths = sorted(r["n"] for r in found.distinct().collect())
    signatures = catalog.select("row", F.explode(_signature(F.col("own"), percent)).alias("hash"))
    # A text is found again by its id and a hash of it: many rows may share an id, or have none.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    probes = texts.select(
        "doc_id",
        "digest",
        F.explode(F.transform(shingles(F.col("text"), size, lengths), lambda s: F.xxhash64(s))).alias("hash"),
    )
    if signatures.count() <= BROADCAST_ROWS:
        signatures = F.broadcast(signatures)
    candidates = stored(probes.join(signatures, "hash").select("doc_id", "digest", "row").distinct(), "candidates")
    same = F.col("found_in").eqNullSafe(F.col("doc_id")) & (F.col("found_digest") == F.col("digest"))
    found = candidates.withColumnsRenamed({"doc_id": "found_in", "digest": "found_digest"})
    if candidates.count() <= BROADCAST_ROWS:
        # Only texts with a candidate are moved for the check.
        texts = texts.join(F.broadcast(found.select("found_in", "found_digest").distinct()), same, "left_semi")
    shared = F.size(F.array_intersect("own", shingles(F.col("text"), size, lengths)))
    return (
        found.join(catalog, "row")
        .join(texts.dropDuplicates(["doc_id", "digest", "text"]), same)
        .select("doc_id", "item_id", F.size("own").alias("n_item_shingles"), shared.alias("n_shared"))
        .where(100 * F.col("n_shared") >= percent * F.col("n_item_shingles"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct(F.col("n_shared") / F.col("n_item_shingles"), "n_item_shingles", "n_shared")).alias("m"))
        .select("doc_id", "item_id", "m.n_item_shingles", "m.n_shared")
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text contains an item; all their columns stay as they are.

    Rows are told apart by 128 bits of their text, which alone decides, and not by doc_id: a row
    stays whatever other rows share its id, or have none.
    """
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    found = contained_items(docs.select(key.alias("doc_id"), "text"), items, short_inside=True)
    contaminated = found.select(F.col("doc_id").alias("contaminated")).distinct()
    of_row = F.unhex(F.md5(docs["text"].cast("binary")))
    return docs.join(contaminated, of_row == F.col("contaminated"), "left_anti")
