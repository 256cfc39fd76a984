"""Row logic of the message stream: parse, flag, classify. Works on streams and on batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import decode_utf8, parse_json
from millrace.sources.schemas import WINE_MESSAGE

# Column order of the event table (fixed values).
MEASURES = [
    "fixed_acidity",
    "volatile_acidity",
    "citric_acid",
    "residual_sugar",
    "chlorides",
    "free_sulfur_dioxide",
    "total_sulfur_dioxide",
    "density",
    "ph",
    "sulphates",
    "alcohol",
]
EVENT_COLUMNS = [*MEASURES, "quality", "quality_group", "kafka_timestamp", "processed_at"]
REQUIRED_COLUMNS = [*MEASURES, "quality", "quality_group"]

# Fields of an anomaly line (fixed values).
ANOMALY_COLUMNS = [
    "fixed_acidity",
    "volatile_acidity",
    "sulphates",
    "alcohol",
    "quality",
    "kafka_timestamp",
    "anomaly_reason",
]


@dataclass(frozen=True)
class Rules:
    """Limits of the stream. Sulphates above the threshold are anomalies; grades up to ``low``
    and ``medium`` name the groups; events below ``min_quality`` are not stored."""

    sulphates: float = 1.0
    low: int = 4
    medium: int = 6
    min_quality: int = 6


def classify_quality(quality: Column | str, rules: Rules = Rules()) -> Column:
    value = F.col(quality) if isinstance(quality, str) else quality
    return (
        F.when(value.isNull(), "unknown")
        .when(value <= rules.low, "low")
        .when(value <= rules.medium, "medium")
        .otherwise("high")
    )


def register_classifier(
    spark: SparkSession, name: str = "classify_quality", rules: Rules = Rules()
) -> None:
    """The classifier for SQL texts, as a SQL function that Spark inlines into the plan."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(quality INT) RETURNS STRING
        RETURN CASE
            WHEN quality IS NULL THEN 'unknown'
            WHEN quality <= {int(rules.low)} THEN 'low'
            WHEN quality <= {int(rules.medium)} THEN 'medium'
            ELSE 'high'
        END
        """
    )


def flag_anomalies(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add is_anomaly and its reason. A missing value is no anomaly."""
    above = F.coalesce(F.col("sulphates") > rules.sulphates, F.lit(False))
    reason = F.when(F.col("is_anomaly"), F.lit(f"sulphates > {rules.sulphates}"))
    return rows.withColumn("is_anomaly", above).withColumn("anomaly_reason", reason)


def flatten_messages(messages: DataFrame) -> DataFrame:
    """Message fields as columns in table naming, with the message time."""
    parsed = messages.select(
        parse_json(decode_utf8("value"), WINE_MESSAGE).alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    fields = [
        F.col(f"message.{name}").alias(name.lower()) for name in WINE_MESSAGE.fieldNames()
    ]
    return parsed.select(*fields, "kafka_timestamp")


def grade_rows(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows that have a grade, with flags and quality group."""
    valid = rows.where(F.col("quality").isNotNull())
    return flag_anomalies(valid, rules).withColumn(
        "quality_group", classify_quality("quality", rules)
    )


def parse_messages(messages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Valid messages with flags and quality group; messages without a grade are dropped."""
    return grade_rows(flatten_messages(messages), rules)


def anomaly_lines(rows: DataFrame, batch_id: int) -> DataFrame:
    """Flagged rows with their fields and one log line each."""
    fields = rows.where("is_anomaly").select(*ANOMALY_COLUMNS)
    line = F.format_string(
        "[ANOMALY] batch_id=%s; data=%s",
        F.lit(str(batch_id)),
        F.to_json(F.struct(*ANOMALY_COLUMNS)),
    )
    return fields.withColumn("log_line", line)


def batch_stats(rows: DataFrame, batch_id: int) -> DataFrame:
    """Statistics per quality group of one batch."""
    return (
        rows.groupBy("quality_group")
        .agg(
            F.count("*").alias("row_count"),
            F.avg("alcohol").alias("avg_alcohol"),
            F.avg("volatile_acidity").alias("avg_volatile_acidity"),
            F.min("ph").alias("min_ph"),
            F.max("ph").alias("max_ph"),
        )
        .select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            "*",
            F.current_timestamp().alias("calculated_at"),
        )
    )


def replay(messages: DataFrame, rounds: int) -> DataFrame:
    """The same messages several times over, numbered by round from 1."""
    return messages.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
