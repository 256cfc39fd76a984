"""Near-duplicate groups: MinHash, banding, verification and connected components.

1. Every text becomes the set of its distinct word shingles (64-bit hashes), the minima of many
   universal hash functions over the set, and one key per band of minima.
2. Texts with equal sets form a class; only one row per class goes on, so copies cost nothing.
3. Classes that share a band key are candidates if their sizes and the low bits of their minima
   allow a link. In buckets of more than CROWD classes it is also counted how many shingles of a
   class are in no other crowded class: these cannot be shared, which bounds the similarity of
   two such classes. So the strongly changed copies of a text, which resemble each other but are
   not linked, fall to a test of two numbers inside the join and are never written as pairs.
   First each class meets one leader, the one with the fewest shingles of its own that leads a
   bucket of the class and may be linked. What the class lacks of its leader's shingles is kept as
   a mask, so that for two classes of one leader it is known how much of the leader both have.
   Components of the links found so far are then computed, and the remaining candidates are all
   pairs of one bucket whose components differ and whose masks allow a link. Within a component no
   pair is needed any more, so a bucket of thousands of near copies gives thousands of candidates,
   not millions, and yet no link between components is left out.
4. A candidate is dropped if its minima differ far more than the threshold allows, and is
   confirmed on the full sets.
5. Components come from large-star and small-star rounds.

The number of bands follows from the threshold, so that a pair exactly at it is missed with a
chance below one in a million. A shingle hash has 64 bits, a set's identity 128.

Defined cases: a text that is null, empty or only blanks has no shingles and is linked with
nothing. One with fewer words than a shingle is one shingle, all its words. Equal texts, repeated
rows included, are in one group. Rows are told apart by ``doc_id``; a null id never is the id of a
group that has others. Texts are read whole, and one text must fit in a task's memory. Other
columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import hashed_words, mixed
from millrace.llm.components import components
from millrace.llm.storage import Scratch, stored
from millrace.session import setting

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80
MINIMA = 140
MISSED = 1e-6
# Standard deviations that an estimate from the minima may lie under the threshold.
SLACK = 5
# Minima whose lowest bits are compared within the join, and the deviations allowed there.
BITS = 128
BIT_SLACK = 7
# Buckets of more classes are crowded; the pairs of all others are at most CROWD times their rows.
CROWD = 16
# Words of 64 bits of the mask of shingles that a class lacks of its leader's; a power of two.
LACK_WORDS = 4

# Ids that are sent to every task at most.
BROADCAST_ROWS = 200_000
# Texts or pairs that a Python worker holds at a time.
BATCH_ROWS = 2_000

_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 1 << 63, MINIMA, np.uint64)
_CHUNK = 2048


def rows_per_band(percent: int, minima: int = MINIMA, missed: float = MISSED) -> int:
    """The most minima in a band for which a pair at the threshold is still found."""
    similarity = percent / 100
    fitting = (
        r for r in range(1, minima + 1) if (1 - similarity**r) ** (minima // r) <= missed
    )
    return max(fitting, default=1)


def shingle_sets(texts: pa.Array, size: int):
    """The sorted distinct shingle hashes of each text, in order."""
    for first, last, words, offsets in hashed_words(texts):
        rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for k in range(size):
            rolled = mixed(rolled * np.uint64(3) + words[k : k + len(rolled)])
        for i in range(last - first):
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            if hi - lo >= size:
                yield np.unique(rolled[lo : hi - size + 1])
            elif hi > lo:
                value = np.full(1, hi - lo, np.uint64)
                for word in words[lo:hi]:
                    value = mixed(value * np.uint64(5) + word)
                yield value
            else:
                yield words[:0]


def minima_of(hashes: np.ndarray) -> np.ndarray:
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), _CHUNK):
        block = _FACTORS[:, None] * hashes[lo : lo + _CHUNK]
        block += _TERMS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _set_key(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def sketcher(size: int, rows: int) -> Callable[[Column], Column]:
    """A function of a text column: struct<n_shingles, set_key, minima, bands, low_bits, high_bits>."""
    n_bands = MINIMA // rows

    @F.arrow_udf(
        "struct<n_shingles: bigint, set_key: binary, minima: binary, bands: array<bigint>,"
        " low_bits: bigint, high_bits: bigint>"
    )
    def sketch(texts: pa.Array) -> pa.Array:
        counts, keys, minima = [], [], []
        for hashes in shingle_sets(texts, size):
            counts.append(len(hashes))
            keys.append(_set_key(hashes) if len(hashes) else None)
            minima.append(minima_of(hashes))
        table = np.array(minima, np.uint32).reshape(len(minima), MINIMA)
        bands = np.broadcast_to(np.arange(1, n_bands + 1, dtype=np.uint64), (len(minima), n_bands))
        for k in range(rows):
            bands = mixed(bands * np.uint64(7) + table[:, k : n_bands * rows : rows])
        bits = np.packbits(table[:, :BITS] & 1, axis=1).reshape(-1).view(np.int64).reshape(len(minima), 2)
        flat = pa.array(np.ascontiguousarray(bands).view(np.int64).reshape(-1))
        ends = pa.array(np.arange(len(minima) + 1, dtype=np.int32) * np.int32(n_bands))
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([row.tobytes() for row in table], pa.binary()),
                pa.ListArray.from_arrays(ends, flat),
                pa.array(bits[:, 0].copy()),
                pa.array(bits[:, 1].copy()),
            ],
            ["n_shingles", "set_key", "minima", "bands", "low_bits", "high_bits"],
        )

    return sketch


def _set_reader(size: int) -> Callable[[Column], Column]:
    @F.arrow_udf("struct<set_key: binary, shingles: array<bigint>>")
    def read(texts: pa.Array) -> pa.Array:
        keys, parts, ends = [], [], [0]
        for hashes in shingle_sets(texts, size):
            keys.append(_set_key(hashes) if len(hashes) else None)
            parts.append(hashes)
            ends.append(ends[-1] + len(hashes))
        flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), lists], ["set_key", "shingles"])

    return read


def _estimator() -> Callable[[Column, Column], Column]:
    """A function of two columns of minima that gives the share of equal ones."""

    @F.arrow_udf("double")
    def estimate(left: pa.Array, right: pa.Array) -> pa.Array:
        shape = (len(left), MINIMA)
        x = np.frombuffer(b"".join(left.to_pylist()), np.uint32).reshape(shape)
        y = np.frombuffer(b"".join(right.to_pylist()), np.uint32).reshape(shape)
        return pa.array((x == y).mean(axis=1))

    return estimate


def _may_link(percent: int) -> Column:
    """Whether the traits of two classes, with and without the suffix _b, allow a link."""
    differing = (1 - percent / 100) / 2
    most = BITS * differing + BIT_SLACK * (BITS * differing * (1 - differing)) ** 0.5
    apart = sum(
        F.bit_count(F.col(name).bitwiseXOR(F.col(f"{name}_b"))) for name in ("low_bits", "high_bits")
    )
    sizes = F.col("n_shingles"), F.col("n_shingles_b")
    # ``own`` counts what no other crowded class has, so it says nothing about the others.
    shared = F.least(sizes[0] - F.col("own"), sizes[1] - F.col("own_b"))
    bounded = F.col("crowded") & F.col("crowded_b")
    # Of one leader's shingles both have at most what no mask denies; beside these they share at
    # most what either has outside the leader and not alone.
    denied = sum(
        F.bit_count(F.col(name).bitwiseOR(F.col(f"{name}_b"))) for name in _LACKS
    )
    both = F.col("n_lead") - denied + F.least("beside", "beside_b")
    led_alike = bounded & F.col("lead").isNotNull() & F.col("lead").eqNullSafe(F.col("lead_b"))
    return (
        (100 * F.least(*sizes) >= percent * F.greatest(*sizes))
        & (apart <= most)
        & (~bounded | (100 * shared >= percent * (sizes[0] + sizes[1] - shared)))
        & (~led_alike | (100 * both >= percent * (sizes[0] + sizes[1] - both)))
    )


def _sets(active: DataFrame, classes: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """(cid, minima, shingles) of the classes in ``active``.

    Only texts of these classes are read and moved, where their ids are few enough to be sent out.
    """
    read = _set_reader(size)
    needed = classes.select("cid", "first_id", "set_key", "minima").join(active, "cid", "left_semi")
    if active.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(needed.select(F.col("first_id").alias("wanted")).distinct())
        documents = documents.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    return (
        needed.join(documents, F.col("first_id").eqNullSafe(F.col("doc_id")))
        .select("cid", "set_key", "minima", read(F.col("text")).alias("found"))
        .where("found.set_key = set_key")
        .groupBy("cid")
        .agg(F.any_value("minima").alias("minima"), F.any_value("found.shingles").alias("shingles"))
    )


def _compared(pairs: DataFrame, sets: DataFrame, percent: int, *more: Column) -> DataFrame:
    """The pairs (a, b) that their minima do not speak against, with the sizes of their sets.

    ``n_a`` and ``n_b`` are the sizes, ``common`` is that of the intersection; other columns of
    the pairs stay, further ones of the sets may be added.
    """
    similarity = percent / 100
    least = similarity - SLACK * (similarity * (1 - similarity) / MINIMA) ** 0.5
    estimate = _estimator()
    kept = [F.col(name) for name in pairs.columns]
    for side in ("a", "b"):
        own = sets.select(
            F.col("cid").alias(side),
            F.col("minima").alias(f"minima_{side}"),
            F.col("shingles").alias(f"shingles_{side}"),
        )
        pairs = pairs.join(own, side)
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    sizes = F.size("shingles_a").alias("n_a"), F.size("shingles_b").alias("n_b")
    likely = pairs.where(estimate(F.col("minima_a"), F.col("minima_b")) >= least)
    return likely.select(*kept, *sizes, common.alias("common"), *more)


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    """The pairs whose intersection is at least ``percent`` hundredths of the union."""
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    return compared.where(100 * F.col("common") >= percent * union).select("a", "b")


def _lacking() -> list[Column]:
    """What a lacks of b, as a mask over hash values: every set bit stands for at least one."""

    def mask(word: int) -> Column:
        own = f"filter(array_except(shingles_b, shingles_a), x -> ((x >> 6) & {LACK_WORDS - 1}) = {word})"
        bits = f"aggregate({own}, 0L, (mask, x) -> mask | shiftleft(1L, CAST(x & 63 AS INT)))"
        return F.expr(bits).alias(f"lacks_{word}")

    return [mask(word) for word in range(LACK_WORDS)]


_SKETCHED = ["n_shingles", "low_bits", "high_bits"]
_LACKS = [f"lacks_{word}" for word in range(LACK_WORDS)]
_LED = ["lead", "n_lead", "beside", *_LACKS]
_OWN = [*_SKETCHED, "own", "crowded"]
_TRAITS = [*_OWN, *_LED]


def _suffixed(names: list[str]) -> list[Column]:
    return [F.col(name).alias(f"{name}_b") for name in names]


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(cid, band, in_crowd, sketched traits) of all buckets with several classes."""
    members = classes.select("cid", *_SKETCHED, F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    crowded = (F.col("n") > CROWD).alias("in_crowd")
    return members.join(buckets, "band").select("cid", "band", *_SKETCHED, crowded)


def _own_shingles(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """(cid, own): how many shingles of a crowded class are in no other one."""
    return (
        sets.join(crowd, "cid", "left_semi")
        .select("cid", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), F.min("cid").alias("cid"))
        .where("n = 1")
        .groupBy("cid")
        .agg(F.count("*").alias("own"))
    )


def _groups(
    classes: DataFrame, documents: DataFrame, shingle_words: int, percent: int, scratch: Scratch
) -> DataFrame:
    """(node, root) of every class that is linked with another one."""
    shared = scratch.stored(_shared_buckets(classes), "shared")
    active = scratch.stored(shared.groupBy("cid").agg(F.max("in_crowd").alias("crowded")), "active")
    sets = scratch.stored(_sets(active, classes, documents, shingle_words), "sets")
    own = _own_shingles(active.where("crowded"), sets)
    candidates = scratch.stored(
        shared.join(active.join(own, "cid", "left"), "cid").select(
            "cid", "band", *_SKETCHED, F.coalesce("own", F.lit(0)).alias("own"), "crowded"
        ),
        "candidates",
    )

    # Crowded classes lead, those with the fewest shingles of their own first.
    unled = candidates.select("*", *(F.lit(None).cast("long").alias(name) for name in _LED))
    rank = F.struct((~F.col("crowded")).alias("alone"), "own", "cid", *_SKETCHED, "crowded")
    leaders = candidates.groupBy("band").agg(F.min(rank).alias("first"))
    led_by = leaders.select(
        "band",
        F.col("first.cid").alias("b"),
        *(F.col(f"first.{name}").alias(f"{name}_b") for name in _OWN),
        *(F.lit(None).cast("long").alias(f"{name}_b") for name in _LED),
    )
    stars = (
        unled.join(led_by, "band")
        .where((F.col("cid") != F.col("b")) & _may_link(percent))
        .groupBy(F.col("cid").alias("a"))
        .agg(F.min(F.struct((~F.col("crowded_b")).alias("alone"), "own_b", "b")).alias("first"))
        .select("a", "first.b", (~F.col("first.alone")).alias("lead_crowded"))
    )
    compared = scratch.stored(_compared(stars, sets, percent, *_lacking()), "stars")
    roots = scratch.stored(components(_linked(compared, percent), scratch.stored), "roots")

    known = compared.join(roots, F.col("a") == F.col("node"), "full").select(
        F.coalesce("a", "node").alias("cid"),
        "root",
        F.col("b").alias("lead"),
        F.col("n_b").alias("n_lead"),
        (F.col("n_a") - F.col("common")).alias("outside"),
        "lead_crowded",
        *_LACKS,
    )
    # Shingles that no other crowded class has are outside a leader that is crowded itself.
    beside = F.col("outside") - F.when(F.col("lead_crowded"), F.col("own")).otherwise(0)
    placed = scratch.stored(
        candidates.join(known, "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
        .withColumn("beside", beside)
        .select("cid", "band", "root", *_TRAITS),
        "placed",
    )
    open_buckets = (
        placed.groupBy("band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("band")
    )
    left = placed.join(open_buckets, "band")
    right = left.select(
        "band",
        F.col("cid").alias("other"),
        F.col("root").alias("other_root"),
        *_suffixed(_TRAITS),
    )
    across = (
        left.join(right, "band")
        .where((F.col("root") < F.col("other_root")) & _may_link(percent))
        .select(F.col("cid").alias("a"), F.col("other").alias("b"))
        .distinct()
    )
    more = _linked(_compared(across, sets, percent), percent)
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return stored(components(stars.unionByName(more), scratch.stored), "groups")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = SIMILARITY_PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Texts are linked if the intersection of their shingle sets is at least ``percent`` hundredths
    of the union. component_id is the smallest doc_id that can be reached, kept says that it is
    the row's own.
    """
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        return _near_duplicates(docs, shingle_words, percent)


def _near_duplicates(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    rows = rows_per_band(percent)
    documents = docs.select("doc_id", "text")
    sketch = sketcher(shingle_words, rows)
    sketches = stored(
        documents.select("doc_id", sketch(F.col("text")).alias("s")).select("doc_id", "s.*"), "sketches"
    )
    classes = stored(
        sketches.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.any_value("minima").alias("minima"),
            F.any_value("bands").alias("bands"),
            *(F.any_value(name).alias(name) for name in _SKETCHED),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )

    with Scratch(docs.sparkSession, "near-dedup") as scratch:
        grouped = _groups(classes, documents, shingle_words, percent, scratch)
    named = classes.join(grouped, F.col("cid") == F.col("node"), "left").select(
        "set_key", "first_id", F.coalesce("root", "cid").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = named.join(smallest, "root").select("set_key", "component_id")
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        sketches.select("doc_id", "n_shingles", "set_key")
        .join(by_set, "set_key", "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
