"""Sinks into databases, catalog tables and document collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict[str, str] | None = None,
) -> None:
    """Write to a database table. Appends are at-least-once: a retried batch appends again."""
    df.write.mode(mode).jdbc(url, table, properties=properties or {})


def delete_batch(
    spark: SparkSession, url: str, table: str, batch_id: int, properties: dict[str, str] | None = None
) -> None:
    """Delete a batch's rows from a database table, by its batch_id column, in the driver."""
    settings = spark._jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        settings.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        statement = connection.prepareStatement(f"DELETE FROM {table} WHERE batch_id = ?")
        statement.setLong(1, batch_id)
        statement.executeUpdate()
    finally:
        connection.close()


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets and bucket columns of a catalog table; None for one without buckets."""
    columns = [c.name for c in spark.catalog.listColumns(table) if c.isBucket]
    if not columns:
        return None
    row = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(row["data_type"]), columns


def fill_table(df: DataFrame, table: str) -> None:
    """Append every row to an existing catalog table, columns matched by name.

    Rows for a bucketed table are dealt out by its buckets first, so that an insert adds one file to
    a bucket and not one per task. A bucket far larger than the others, that of a hot key, is
    written by several tasks, where adaptive execution splits it.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    spec = bucket_spec(spark, table)
    if spec:
        buckets, columns = spec
        rows = rows.hint("rebalance", buckets, *(F.col(f"`{c}`") for c in columns))
    rows.write.insertInto(table)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
