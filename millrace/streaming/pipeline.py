"""The stream job: one micro-batch to events, statistics, anomalies and rejected rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.constraints import has_no_nulls, null_violations
from millrace.sinks.files import write_batch
from millrace.sinks.tables import delete_batch, write_jdbc
from millrace.sources.files import or_empty
from millrace.sources.folders import path_exists, read_small, write_small
from millrace.streaming.messages import (
    EVENT_COLUMNS,
    REQUIRED_COLUMNS,
    Rules,
    anomaly_lines,
    batch_stats,
    flatten_messages,
    grade_rows,
)

MEASURES_DDL = (
    "fixed_acidity double, volatile_acidity double, citric_acid double, residual_sugar double, "
    "chlorides double, free_sulfur_dioxide double, total_sulfur_dioxide double, density double, "
    "ph double, sulphates double, alcohol double, quality int, quality_group string, "
    "kafka_timestamp timestamp"
)
SCHEMAS = {
    "events": f"{MEASURES_DDL}, processed_at timestamp, batch_id bigint",
    "rejects": f"{MEASURES_DDL}, violated string, batch_id bigint",
    "stats": (
        "quality_group string, row_count bigint, avg_alcohol double, "
        "avg_volatile_acidity double, min_ph double, max_ph double, calculated_at timestamp, "
        "batch_id bigint"
    ),
    "anomalies": (
        "fixed_acidity double, volatile_acidity double, sulphates double, alcohol double, "
        "quality int, kafka_timestamp timestamp, anomaly_reason string, log_line string, "
        "batch_id bigint"
    ),
}


@dataclass(frozen=True)
class FileSinks:
    """Four parquet folders below one root, partitioned by batch. A repeated batch replaces its
    own rows, so a restart leaves neither gaps nor copies."""

    root: str

    def write(self, name: str, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{self.root}/{name}", batch_id)

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        """Note that all outputs of a batch, and so of all before it, are written."""
        write_small(spark, f"{self.root}/_finished", str(batch_id))

    def finished(self, spark: SparkSession) -> int | None:
        """The last batch of which all outputs are written; None before the first."""
        text = read_small(spark, f"{self.root}/_finished")
        return None if text is None else int(text)

    def read(self, spark: SparkSession, name: str, whole_batches: bool = False) -> DataFrame:
        """All stored rows of one output; none when no batch has written any yet.

        With ``whole_batches``, rows of a batch count only when all its outputs are written, so that
        outputs read together agree while a job runs or after it broke off. A root that does not
        exist is an error, not an empty output.
        """
        if not path_exists(spark, self.root):
            raise FileNotFoundError(f"no stream outputs below {self.root}")
        schema = SCHEMAS[name]
        rows = or_empty(
            spark, schema, lambda: spark.read.schema(schema).parquet(f"{self.root}/{name}")
        )
        if not whole_batches:
            return rows
        last = self.finished(spark)
        # Batches run one after the other, so all before a finished one are finished.
        return rows.where(F.col("batch_id") <= (-1 if last is None else last))


@dataclass(frozen=True)
class DatabaseSinks:
    """Database tables named in ``tables``; other outputs are files.

    Event and statistics rows go to the database; anomalies and rejects stay in files. The tables
    have a batch_id column: a batch's rows are deleted before they are appended, so a repeated
    batch replaces its own.
    """

    url: str
    tables: dict[str, str]
    properties: dict[str, str]
    files: FileSinks

    def write(self, name: str, rows: DataFrame, batch_id: int) -> None:
        if name in self.tables:
            table = self.tables[name]
            delete_batch(rows.sparkSession, self.url, table, batch_id, self.properties)
            numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            write_jdbc(numbered, self.url, table, properties=self.properties)
        else:
            self.files.write(name, rows, batch_id)

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        self.files.finish(spark, batch_id)


class Sinks(Protocol):
    """Where the outputs of a batch go, by name."""

    def write(self, name: str, rows: DataFrame, batch_id: int) -> None: ...

    def finish(self, spark: SparkSession, batch_id: int) -> None: ...


def write_micro_batch(
    rows: DataFrame, batch_id: int, sinks: Sinks, rules: Rules = Rules()
) -> None:
    """Write one batch of flattened messages, kept in memory while its outputs are written.

    The rows are kept before they are filtered: a filter in front of the parse would make Spark
    parse every message twice. Rows that lack a required value go to the rejects with the column
    named, so that one such row does not fail the whole batch. A batch with rows writes all its
    outputs, empty ones too, so that a repeated batch leaves nothing of its earlier attempt, and is
    marked as finished after the last one.
    """
    rows = rows.persist()
    try:
        if rows.isEmpty():
            return
        graded = grade_rows(rows, rules)
        sinks.write("anomalies", anomaly_lines(graded, batch_id), batch_id)
        kept = graded.where(~F.col("is_anomaly") & (F.col("quality") >= rules.min_quality))
        plain = kept.drop("is_anomaly", "anomaly_reason")
        sinks.write("rejects", null_violations(plain, REQUIRED_COLUMNS), batch_id)
        complete = plain.where(has_no_nulls(REQUIRED_COLUMNS))
        events = complete.withColumn("processed_at", F.current_timestamp())
        sinks.write("events", events.select(*EVENT_COLUMNS), batch_id)
        sinks.write("stats", batch_stats(complete, batch_id), batch_id)
        sinks.finish(rows.sparkSession, batch_id)
    finally:
        rows.unpersist()


def start_stream(
    messages: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    rules: Rules = Rules(),
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Start the job over a message stream; progress is kept in the checkpoint folder."""
    writer = (
        flatten_messages(messages)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda rows, batch_id: write_micro_batch(rows, batch_id, sinks, rules))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def merged_stats(stats: DataFrame) -> DataFrame:
    """Statistics over all batches, from the per-batch rows: averages weighted by row count."""
    rows = F.sum("row_count")
    return stats.groupBy("quality_group").agg(
        rows.alias("row_count"),
        (F.sum(F.col("avg_alcohol") * F.col("row_count")) / rows).alias("avg_alcohol"),
        (F.sum(F.col("avg_volatile_acidity") * F.col("row_count")) / rows).alias(
            "avg_volatile_acidity"
        ),
        F.min("min_ph").alias("min_ph"),
        F.max("max_ph").alias("max_ph"),
    )
