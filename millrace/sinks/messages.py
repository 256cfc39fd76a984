"""Keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import row_json
from millrace.operators.keys import assign_dense_ids


def to_messages(df: DataFrame, order_by: list[str], drop_order: bool = False) -> DataFrame:
    """One message per row: the key is the 1-based row number as text, the value the row as JSON."""
    payload = [name for name in df.columns if not (drop_order and name in order_by)]
    numbered = assign_dense_ids(df, order_by, "message_number")
    return numbered.select(
        F.col("message_number").cast("string").alias("key"), row_json(*payload).alias("value")
    )


def write_messages(
    messages: DataFrame,
    sink_format: str = "kafka",
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    **options: str,
) -> None:
    """Publish messages; Kafka waits for all replicas and retries five times."""
    writer = messages.write.format(sink_format)
    if sink_format == "kafka":
        writer = (
            writer.option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("kafka.acks", "all")
            .option("kafka.retries", "5")
        )
    writer = writer.options(**options)
    writer.save(path) if path else writer.save()
