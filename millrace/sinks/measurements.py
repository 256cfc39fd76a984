"""Appendable measurement log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import safe_ratio
from millrace.operators.keys import assign_dense_ids
from millrace.sources.files import or_empty
from millrace.sources.measurements import read_log

FIELDS = [
    "len_values",
    "k",
    "workers",
    "sequential_time",
    "parallel_time",
    "speedup",
    "efficiency",
]


def with_speedup(runs: DataFrame) -> DataFrame:
    """Add speedup (sequential over parallel time) and efficiency (speedup per worker)."""
    return runs.withColumn(
        "speedup", safe_ratio("sequential_time", "parallel_time")
    ).withColumn("efficiency", safe_ratio("speedup", "workers"))


def next_record_id(spark: SparkSession, path: str) -> int:
    """One more than the largest id in the log, 0 for a log that does not exist or is empty."""
    records = or_empty(spark, "record_id bigint", lambda: read_log(spark, path))
    last = records.agg(F.max("record_id").alias("last")).first()["last"]
    return 0 if last is None else int(last) + 1


def append_measurements(runs: DataFrame, path: str, order_by: list[str]) -> None:
    """Append runs to the log as one JSON document per line, ids continuing from the last one.

    Runs without speedup and efficiency get them after they are numbered, so that what is moved
    and stored for it are the measured values alone. Lines repeat their field names and are
    compressed; a file is then read by one task, and holds what one task wrote.
    """
    spark = runs.sparkSession
    start = next_record_id(spark, path)
    numbered = assign_dense_ids(runs, order_by, "record_id", start=start)
    if "speedup" not in runs.columns:
        numbered = with_speedup(numbered)
    record = F.struct(*FIELDS)
    lines = numbered.select(
        F.to_json(F.create_map(F.col("record_id").cast("string"), record)).alias("value")
    )
    lines.write.mode("append").option("compression", "gzip").text(path)
