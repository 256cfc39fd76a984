"""Rows per segment of a hash distribution, and the skew that follows from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import safe_ratio


# The number of the bucket in the name of a bucket file.
BUCKET_OF_FILE = r"_(\d+)(?:\.[^_]*)?$"


def hash_segment(key: str, segments: int) -> Column:
    """The partition Spark's hash partitioning picks for a key."""
    return F.pmod(F.hash(F.col(key)), F.lit(segments))


def segment_counts(
    df: DataFrame, table_name: str, segment: Column, segments: int
) -> DataFrame:
    """Rows per segment 0 .. segments-1. Empty segments are listed with 0 rows."""
    spark = df.sparkSession
    counted = df.groupBy(segment.cast("int").alias("segment_id")).agg(
        F.count("*").alias("row_count")
    )
    every = spark.range(segments).select(F.col("id").cast("int").alias("segment_id"))
    return every.join(counted, "segment_id", "left").select(
        F.lit(table_name).alias("table_name"),
        "segment_id",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )


def replicated_counts(df: DataFrame, table_name: str, segments: int) -> DataFrame:
    """Rows per segment of a table that is stored whole on every segment."""
    total = df.agg(F.count("*").alias("row_count"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))
    return total.select(
        F.lit(table_name).alias("table_name"), copies.alias("segment_id"), "row_count"
    )


def stored_segments(table: DataFrame, table_name: str, segments: int, key: str) -> DataFrame:
    """Rows per segment as they lie in the files of a bucketed table, and whether they belong there.

    The segment is read from the name of the file that holds a row. ``placed`` tells that the key
    of every row of the segment hashes to it; an empty segment is listed with 0 rows, as placed.
    """
    spark = table.sparkSession
    bucket = F.regexp_extract(F.col("_metadata.file_name"), BUCKET_OF_FILE, 1).cast("int")
    held = (
        table.select(bucket.alias("segment_id"), hash_segment(key, segments).alias("hashed"))
        .groupBy("segment_id")
        .agg(F.count("*").alias("row_count"), F.bool_and(F.col("hashed") == F.col("segment_id")).alias("placed"))
    )
    every = spark.range(segments).select(F.col("id").cast("int").alias("segment_id"))
    return every.join(held, "segment_id", "left").select(
        F.lit(table_name).alias("table_name"),
        "segment_id",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("placed", F.lit(True)).alias("placed"),
    )


def write_replicated(df: DataFrame, path: str, segments: int) -> None:
    """Store a table once per segment, each copy whole in a folder of its own.

    For dimensions: a segment then finds all their rows in its own copy.
    """
    copies = F.explode(F.sequence(F.lit(0), F.lit(segments - 1)))
    df.select("*", copies.alias("segment_id")).write.partitionBy("segment_id").parquet(path)


def read_copy(spark: SparkSession, path: str, segment: int) -> DataFrame:
    """The copy of one segment; no other folder is read."""
    return spark.read.parquet(f"{path}/segment_id={segment}")


def replicated_segments(spark: SparkSession, path: str, table_name: str, segments: int) -> DataFrame:
    """Rows per segment as they lie in the copies; ``placed`` tells that a copy equals the first.

    Copies are compared by the number of rows and an order-free sum of row hashes.
    """
    rows = spark.read.parquet(path)
    names = [f"`{c}`" for c in rows.columns if c != "segment_id"]
    held = rows.groupBy("segment_id").agg(
        F.count("*").alias("row_count"),
        F.sum(F.xxhash64(*names).cast("decimal(20,0)")).alias("digest"),
    )
    first = held.where("segment_id = 0").select(
        F.col("row_count").alias("first_count"), F.col("digest").alias("first_digest"), F.lit(True).alias("one")
    )
    every = spark.range(segments).select(F.col("id").cast("int").alias("segment_id"), F.lit(True).alias("one"))
    same = F.col("row_count").eqNullSafe(F.col("first_count")) & F.col("digest").eqNullSafe(F.col("first_digest"))
    return (
        every.join(held, "segment_id", "left")
        .join(first, "one", "left")
        .select(
            F.lit(table_name).alias("table_name"),
            "segment_id",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            same.alias("placed"),
        )
    )


def union_counts(counts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, counts)


def skew_report(counts: DataFrame) -> DataFrame:
    """Share of each segment and skew of each table, both in percent.

    Skew is (largest - smallest) / average * 100, and 0 for an empty table. A window group is the
    segment list of one table.
    """
    table = Window.partitionBy("table_name")
    total = F.sum("row_count").over(table)
    spread = F.max("row_count").over(table) - F.min("row_count").over(table)
    average = F.avg("row_count").over(table)
    return counts.select(
        "table_name",
        "segment_id",
        "row_count",
        total.alias("total_rows"),
        (F.coalesce(safe_ratio("row_count", total), F.lit(0.0)) * 100).alias("share_pct"),
        (F.coalesce(safe_ratio(spread, average), F.lit(0.0)) * 100).alias("skew_pct"),
    )
