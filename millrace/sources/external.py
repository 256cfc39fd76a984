"""Readers for systems outside Spark: databases, document stores, object stores, messages.

Connector formats and addresses are arguments; the connector jars come with the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Database table; with a numeric partition column and bounds it is read in parallel."""
    properties = properties or {}
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if lower is None or upper is None or partitions is None:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def read_documents(
    spark: SparkSession, schema: str, source_format: str = "mongodb", **options: str
) -> DataFrame:
    """Document collection with nested arrays; also reads JSON or parquet folders by path."""
    return spark.read.format(source_format).schema(schema).options(**options).load()


def read_message_stream(
    spark: SparkSession,
    source_format: str = "kafka",
    servers: str | None = None,
    topic: str | None = None,
    schema: str | None = None,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded messages with key, value and timestamp.

    Kafka starts at the earliest offset and goes on when offsets were lost. Any other streaming
    format gets the schema and the path.
    """
    reader = spark.readStream.format(source_format)
    if source_format == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
        )
    if schema:
        reader = reader.schema(schema)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True
) -> dict[str, str]:
    """Session settings for an S3-compatible store; the caller supplies the credentials."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.fast.upload": "true",
    }
