"""Removal of lines that many documents share, by levelled sorted runs of line hashes.

A line's key is the line without blanks (space and 0x09 to 0x0D) at its ends, A-Z in lower case.
A key of at least ``min_chars`` code points that at least ``min_documents`` documents hold loses
all its lines but those in the largest doc_id that holds it.

1. Every text is split once; its long lines become rows of two 64-bit hashes of the key, the
   document, the line's place and whether it is the key's first line in that text.
2. The documents come in batches from the largest doc_id down. A batch is summed up to one row
   per key (documents, largest doc_id), without the keys that some run already counts as frequent:
   a merge anti-join against every run, all of them bucketed and sorted by the hashes, so that no
   run moves. What is left is added as a run of its own on the lowest level.
3. Two runs of a level are merged into one run of the next level, by a full merge join, bucket by
   bucket. As later batches hold smaller ids only, the largest doc_id of a key that is already
   frequent cannot change.
4. The runs are merged at the end; the lines of frequent keys give the places to remove, per
   document, and these meet the texts.

Identity of a key is 128 bits. All of it are column expressions and joins; no line or document is
collected. Frequent keys may be on any number of lines: sums are made before rows move, and the
one join on keys (step 4) is split by adaptive execution.

Defined cases: a null text is one empty line and stays null; a row is a document, so rows that
share a doc_id count as several, and all rows of the largest doc_id keep their lines; a null
doc_id is smaller than every other. Columns of the input stay as they are, but for those with the
names of new ones, which are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.spans import let
from millrace.llm.storage import Scratch, stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_CHARS = 40
MIN_DOCUMENTS = 5
BATCHES = 4

KEY = ["h1", "h2"]


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; texts of one byte per character take the short way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(text: Column, min_chars: int) -> Column:
    """array<struct<h1, h2, at, first>> of the lines whose key is long enough, by hash and place."""

    def hashed(key: Column, at: Column) -> Column:
        return F.when(
            F.length(key) >= min_chars,
            F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), at.alias("at")),
        )

    def marked(rows: Column) -> Column:
        def row(x: Column, i: Column) -> Column:
            before = F.get(rows, i - 1)
            first = (i == 0) | (before["h1"] != x["h1"]) | (before["h2"] != x["h2"])
            return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["at"].alias("at"), first.alias("first"))

        return F.transform(rows, row)

    keys = F.transform(F.split(lowered(text), "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)))
    found = F.filter(F.transform(keys, hashed), lambda x: x.isNotNull())
    return let(F.array_sort(found), marked)


class LineRuns:
    """Counts of line keys as sorted runs in levels.

    Batches must come in descending order of doc_id. Tables and files live in the scratch folder
    that is passed in; ``close`` removes the catalog's names.
    """

    def __init__(self, scratch: Scratch, min_documents: int = MIN_DOCUMENTS):
        self.scratch = scratch
        self.spark: SparkSession = scratch.spark
        self.min_documents = min_documents
        # One place per level, for a run that waits for a second one.
        self.levels: list[str | None] = []
        self.names: list[str] = []
        # As many buckets as a shuffle has partitions: a run is written as it was shuffled.
        self.buckets = self.spark._jsparkSession.sessionState().conf().numShufflePartitions()

    def add(self, lines: DataFrame) -> None:
        """Count a batch of lines and compact the levels that are full."""
        documents = F.sum(F.col("first").cast("bigint")).alias("documents")
        own = lines.groupBy(*KEY).agg(documents, F.max("doc_id").alias("last"))
        for run in self.runs():
            frequent = self.spark.table(run).where(F.col("documents") >= self.min_documents)
            own = own.join(frequent, KEY, "left_anti")
        self._put(self._written(own), 0)

    def frequent(self) -> DataFrame:
        """h1, h2, keeper: every key of enough documents and the largest doc_id that holds it."""
        runs = self.runs()
        while len(runs) > 1:
            runs = [self._merged(runs[0], runs[1]), *runs[2:]]
        keys = self.spark.table(runs[0]).where(F.col("documents") >= self.min_documents)
        return keys.select(*KEY, F.col("last").alias("keeper"))

    def runs(self) -> list[str]:
        return [name for name in self.levels if name]

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _put(self, run: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append(None)
        waiting, self.levels[level] = self.levels[level], None
        if waiting:
            self._put(self._merged(waiting, run), level + 1)
        else:
            self.levels[level] = run

    def _merged(self, left: str, right: str) -> str:
        """One run of two. A union would not do: it loses the buckets, or claims to keep them."""
        a, b = self.spark.table(left).alias("a"), self.spark.table(right).alias("b")
        count = F.coalesce("a.documents", F.lit(0)) + F.coalesce("b.documents", F.lit(0))
        last = F.greatest("a.last", "b.last")
        merged = self._written(a.join(b, KEY, "full").select(*KEY, count.alias("documents"), last.alias("last")))
        for name in (left, right):
            self.scratch.delete(name)
        return merged

    def _written(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        writer = rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", f"{self.scratch.root}/{name}").saveAsTable(name)
        return name


def _batches(documents: DataFrame, count: int) -> list[Column]:
    """Conditions on doc_id that deal the rows out to batches, the largest ids first."""
    shares = [i / count for i in range(count - 1, 0, -1)]
    bounds = documents.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] or []
    bounds = list(dict.fromkeys(bounds))
    if not bounds:
        return [F.lit(True)]
    doc_id = F.col("doc_id")
    between = [(doc_id > low) & (doc_id <= high) for high, low in zip(bounds, bounds[1:])]
    return [doc_id > bounds[0], *between, doc_id.isNull() | (doc_id <= bounds[-1])]


def dropped_places(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """doc_id, digest, dropped: the places of the lines to remove, for each document with any.

    ``digest`` is a hash of the text. What a document loses depends on its doc_id and its lines
    only, so equal rows share a result, and a doc_id that many rows have is no single group.
    """
    spark = documents.sparkSession
    with Scratch(spark, "line-dedup") as scratch:
        # The digest is taken before the lines become rows, else every line would hash the whole text.
        found = documents.select(
            "doc_id", F.xxhash64("text").alias("digest"), long_lines(F.col("text"), min_chars).alias("rows")
        ).select("doc_id", "digest", F.inline("rows"))
        conditions = _batches(documents, batches)
        number = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(conditions)])
        lines = scratch.stored_by(found.withColumn("batch", number), "lines", "batch")
        runs = LineRuns(scratch, min_documents)
        try:
            for i in range(len(conditions)):
                runs.add(lines.where(F.col("batch") == i))
            frequent = scratch.stored(runs.frequent(), "frequent")
        finally:
            runs.close()
        others = ~F.col("doc_id").eqNullSafe(F.col("keeper"))
        removed = lines.join(frequent, KEY).where(others)
        # A set, as rows may be repeated any number of times.
        places = removed.groupBy("doc_id", "digest").agg(F.collect_set("at").alias("dropped"))
        return stored(places, "dropped-lines")


def without_shared_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """All documents with the text that stays, and two more columns.

    ``n_lines`` counts the lines before removal, ``n_dropped`` those removed.
    """
    dropped = dropped_places(documents, min_chars, min_documents, batches)
    dropped = dropped.select(
        F.col("doc_id").alias("_dropped_id"), F.col("digest").alias("_dropped_digest"), F.col("dropped").alias("_dropped")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_dropped_id")) & (F.xxhash64("text") == F.col("_dropped_digest"))

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_dropped"))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(let(lines_of(F.col("text")), kept))
    counts = {
        "n_lines": F.size(lines_of(F.col("text"))).cast("long"),
        "n_dropped": F.coalesce(F.array_size("_dropped"), F.lit(0)).cast("long"),
    }
    joined = documents.drop("n_lines", "n_dropped").join(dropped, same, "left")
    return joined.withColumns({**counts, "text": text}).drop("_dropped_id", "_dropped_digest", "_dropped")
