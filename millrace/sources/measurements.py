"""Reader for logs of recorded measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import parse_json
from millrace.sources.schemas import MEASUREMENT

LOG_SCHEMA = f"map<string, struct<{MEASUREMENT}>>"
ROW_ORDER = ["k", "len_values", "workers"]


def parse_log(documents: DataFrame, text: Column | str = "value", strict: bool = True) -> DataFrame:
    """One row per record of JSON documents that map a record id to its fields.

    A malformed document fails, or gives no records when not strict; a blank line is none.
    """
    text = F.col(text) if isinstance(text, str) else text
    parsed = parse_json(F.nullif(F.trim(text), F.lit("")), LOG_SCHEMA, strict)
    records = documents.select(F.explode(parsed).alias("record_id", "record"))
    return records.select(F.col("record_id").cast("bigint").alias("record_id"), "record.*")


def read_log(spark: SparkSession, path: str, single_document: bool = False) -> DataFrame:
    """Log as rows. The appendable form has one document per line and is read in parallel;
    ``single_document`` reads files that hold one JSON object each, up to 2 GB, in one row."""
    return parse_log(spark.read.text(path, wholetext=single_document))


def sorted_records(records: DataFrame) -> DataFrame:
    return records.orderBy(*[F.asc_nulls_last(name) for name in (*ROW_ORDER, "record_id")])
