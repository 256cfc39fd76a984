"""Short codes of vectors: product quantization by member-resident Lloyd rounds.

A vector of whole numbers is cut into equal consecutive parts; each part position has a codebook
of entries, and a part is coded by the index of its nearest entry (squared Euclidean distance,
ties to the lower index). The codebooks start as the parts of the smallest kept vec_ids.

1. The parts are rows, each living with its owner: (position, entry, salt), by which the table of
   members is bucketed. The salt splits entries with many members over several owners.
2. In a round the owners sum up their resident members, which moves no member; the sums of the
   salts of an entry are added, and componentwise floor(sum / count) is the new entry. An entry
   without members stays.
3. Members are assigned anew where they live. Those that keep their entry are written to the same
   bucket by the task that read them; only parts that change their entry go through the shuffle.
4. After the last round every vector is coded with the final codebooks, in one pass.

Codebooks have POSITIONS x ENTRIES rows at most, whatever the input, and are all that passes
through the driver. Distances are whole numbers in blocks of bounded size, so results are exact
and do not depend on the order of the rows.

Defined cases: a vector that is null or empty, or holds null or non-finite components, is dropped, as is one
whose length differs from that of the smallest kept vec_id or is no multiple of POSITIONS. A null
vec_id sorts last; equal vec_ids are ordered by their components. With fewer vectors than ENTRIES the
codebooks have as many entries. Components are held to +-MAX_WHOLE, so that all sums fit 64 bits.
Columns of the input other than vec_id, embedding and label play no part. Repeated rows each get a
row. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import Scratch, stored
from millrace.session import setting

POSITIONS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Largest component after scaling: squares of differences of a part then fit 64 bits.
MAX_WHOLE = 1 << 28
# Members that an owner should have at most.
OWNER_ROWS = 4096
# Rows whose distances are held at a time.
BLOCK_ROWS = 512

OWNER = ["position", "entry", "salt"]


@dataclass(frozen=True)
class Codebooks:
    """entries[position, index, component] as 64-bit integers."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, position: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and the squared distance to it, for rows of whole numbers."""
        book = self.entries[position]
        index = np.zeros(len(parts), np.int64)
        distance = np.zeros(len(parts), np.int64)
        for at in range(0, len(parts), BLOCK_ROWS):
            block = parts[at : at + BLOCK_ROWS]
            square = _squares(block, book)
            best = square.argmin(axis=1)
            index[at : at + BLOCK_ROWS] = best
            distance[at : at + BLOCK_ROWS] = square[np.arange(len(block)), best]
        return index, distance


def _squares(block: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries.

    Products of doubles are exact while they stay under 2**53, which the largest component tells.
    """
    top = max(int(np.abs(block).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * book.shape[1] * top * top < 1 << 53:
        a, b = block.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    total = np.zeros((len(block), len(book)), np.int64)
    for k in range(book.shape[1]):
        step = block[:, k, None] - book[None, :, k]
        total += step * step
    return total


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, whole: the kept vectors with every component as floor(SCALE * x)."""
    whole = F.transform("embedding", _whole)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = F.col("embedding").isNotNull() & ~bad & (F.size("embedding") > 0)
    return embeddings.where(kept).select("vec_id", "label", whole.alias("whole"))


def _whole(x: Column) -> Column:
    scaled = F.floor(F.least(F.greatest(x.cast("double"), F.lit(-MAX_WHOLE)), F.lit(MAX_WHOLE)) * SCALE)
    return F.least(F.greatest(scaled, F.lit(-MAX_WHOLE)), F.lit(MAX_WHOLE)).cast("bigint")


def first_codebooks(vectors: DataFrame) -> Codebooks | None:
    """The parts of the ENTRIES smallest vec_ids; None if no vector can be cut."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("whole").asc()]
    rows = [r["whole"] for r in vectors.orderBy(*order).limit(ENTRIES).select("whole").collect()]
    rows = [r for r in rows if len(r) == len(rows[0])]
    if not rows or len(rows[0]) % POSITIONS:
        return None
    whole = np.array(rows, np.int64).reshape(len(rows), POSITIONS, -1)
    return Codebooks(np.ascontiguousarray(whole.transpose(1, 0, 2)))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal length as rows of one array."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assigned(books: Codebooks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members with the entry they have and, in ``target``, the one they belong to."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            position = batch.column("position").to_numpy()
            parts = _matrix(batch.column("part"))
            target = np.zeros(batch.num_rows, np.int32)
            for p in np.unique(position):
                rows = np.flatnonzero(position == p)
                target[rows] = books.nearest(int(p), parts[rows])[0]
            columns = {name: batch.column(name) for name in (*OWNER, "part")}
            yield pa.RecordBatch.from_pydict({**columns, "target": pa.array(target)})

    return step


MEMBER = "position int, entry int, salt bigint, part array<bigint>, target int"


def _coded(books: Codebooks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = _matrix(batch.column("whole")).reshape(batch.num_rows, POSITIONS, -1)
            codes = np.zeros((batch.num_rows, POSITIONS), np.int64)
            error = np.zeros(batch.num_rows, np.int64)
            for p in range(POSITIONS):
                codes[:, p], distance = books.nearest(p, parts[:, p])
                error += distance
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "code": pa.array(text, pa.string()),
                    "error": pa.array(error),
                }
            )

    return step


class Members:
    """The parts of all vectors, bucketed by owner, one generation after the other."""

    def __init__(self, scratch: Scratch, salts: int):
        self.scratch = scratch
        self.spark = scratch.spark
        self.salts = salts
        self.buckets = self.spark._jsparkSession.sessionState().conf().numShufflePartitions()
        self.table: str | None = None

    def settle(self, vectors: DataFrame, books: Codebooks) -> None:
        """All parts go to the owner of their nearest entry."""
        size = books.entries.shape[2]
        parts = [F.slice("whole", p * size + 1, size) for p in range(POSITIONS)]
        rows = vectors.select(
            F.lit(-1).alias("entry"),
            F.pmod(F.monotonically_increasing_id(), F.lit(self.salts)).alias("salt"),
            F.posexplode(F.array(*parts)).alias("position", "part"),
        )
        assigned = rows.select(*OWNER, "part").mapInArrow(_assigned(books), MEMBER)
        self._write(self._moved(assigned))

    def migrate(self, books: Codebooks) -> None:
        """Parts whose entry changes move to its owner; all others are written where they are."""
        with setting(self.spark, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false"):
            assigned = self.spark.table(self.table).select(*OWNER, "part").mapInArrow(_assigned(books), MEMBER)
            stay = assigned.where(F.col("entry") == F.col("target")).drop("target")
            leave = self._moved(assigned.where(F.col("entry") != F.col("target")))
            self._write(stay.unionByName(leave))

    def updated(self, books: Codebooks) -> Codebooks:
        """Entries as the componentwise floor of the mean of their resident members."""
        size = books.entries.shape[2]
        sums = [F.sum(F.get("part", F.lit(k))).alias(f"s{k}") for k in range(size)]
        owners = self.spark.table(self.table).groupBy(*OWNER).agg(F.count("*").alias("n"), *sums)
        totals = [F.sum(f"s{k}").alias(f"s{k}") for k in range(size)]
        entries = owners.groupBy("position", "entry").agg(F.sum("n").alias("n"), *totals)
        found = books.entries.copy()
        for row in entries.collect():
            found[row["position"], row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(size)]
        return Codebooks(found)

    def close(self) -> None:
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            self.scratch.delete(self.table)
            self.table = None

    def _moved(self, assigned: DataFrame) -> DataFrame:
        rows = assigned.select("position", F.col("target").alias("entry"), "salt", "part")
        return rows.repartition(self.buckets, *OWNER)

    def _write(self, rows: DataFrame) -> None:
        name = f"members_{uuid.uuid4().hex}"
        path = f"{self.scratch.root}/{name}"
        rows.write.bucketBy(self.buckets, *OWNER).option("path", path).saveAsTable(name)
        self.close()
        self.table = name


def vector_codes(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, code and error of every kept vector, and the final codebooks.

    ``code`` holds two hex digits per position, ``error`` the squared distance to the coded vector.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings)
    books = first_codebooks(vectors)
    if books is None:
        schema = f"vec_id bigint, label {dict(embeddings.dtypes)['label']}, code string, error bigint"
        return spark.createDataFrame([], schema), None
    vectors = vectors.where(F.size("whole") == POSITIONS * books.entries.shape[2])
    with Scratch(spark, "vector-codes") as scratch:
        members = Members(scratch, salts=-(-vectors.count() // OWNER_ROWS))
        members.settle(vectors, books)
        try:
            books = members.updated(books)
            for _ in range(rounds - 1):
                members.migrate(books)
                books = members.updated(books)
        finally:
            members.close()
    types = dict(vectors.dtypes)
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint"
    return stored(vectors.mapInArrow(_coded(books), schema), "vector-codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the sum of the errors over all rows of a label; rows without a label are one group."""
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
