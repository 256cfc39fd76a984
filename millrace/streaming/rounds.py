"""Finite data as an endless stream: the same messages sent round after round to a running query.

A sender writes each round as files below one folder, and a query that keeps running reads them
under an admission limit. A round is sent when all of the last one is read, so a query can be
watched over as many rounds as wanted, and sending may go on from any round after a stop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.files import write_batch
from millrace.sources.external import read_message_stream
from millrace.sources.files import or_empty
from millrace.sources.folders import child_names, make_folder

COUNTS = "key string, body bigint, times bigint, batch_id bigint"


@dataclass(frozen=True)
class Rounds:
    """A sender and a counting reader below one folder.

    A round is sent in ``files`` files, dealt out by the message key. The reader admits at most
    ``per_batch`` of them to a micro-batch.
    """

    spark: SparkSession
    path: str
    schema: str
    files: int = 8
    per_batch: int = 4

    def send(self, messages: DataFrame) -> None:
        """One round. A file appears as a whole, but the files of a round one after the other."""
        messages.repartition(self.files, "key").write.mode("append").parquet(f"{self.path}/in")

    def start(self) -> StreamingQuery:
        """Count the messages of every micro-batch by key and body until stopped."""
        messages = read_message_stream(
            self.spark,
            "parquet",
            schema=self.schema,
            path=f"{self.path}/in",
            maxFilesPerTrigger=str(self.per_batch),
        )

        def count(rows: DataFrame, batch_id: int) -> None:
            if rows.isEmpty():
                return
            counted = rows.groupBy("key", F.xxhash64("value").alias("body")).agg(F.count("*").alias("times"))
            write_batch(counted, f"{self.path}/counts", batch_id)

        return (
            messages.writeStream.option("checkpointLocation", f"{self.path}/progress").foreachBatch(count).start()
        )

    def run(self, messages: DataFrame, rounds: int) -> None:
        """Send a number of rounds to a running query, each when the one before it is read."""
        # The file source must find the folder before the first round.
        make_folder(self.spark, f"{self.path}/in")
        query = self.start()
        try:
            for _ in range(rounds):
                self.send(messages)
                query.processAllAvailable()
        finally:
            query.stop()

    def counts(self) -> DataFrame:
        """Messages by micro-batch, key and hash of the body."""
        return or_empty(
            self.spark, COUNTS, lambda: self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts")
        )

    def batches(self) -> int:
        """Micro-batches with messages that have been counted."""
        return sum(name.startswith("batch_id=") for name in child_names(self.spark, f"{self.path}/counts"))


def sent_times(counts: DataFrame) -> DataFrame:
    """How often each key came, with how many bodies, and in how many micro-batches."""
    return counts.groupBy("key").agg(
        F.sum("times").alias("times"),
        F.countDistinct("body").alias("bodies"),
        F.countDistinct("batch_id").alias("batches"),
    )
