"""Dense row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import working_path

# monotonically_increasing_id() puts the partition number above bit 33 and the position below.
POSITION_BITS = 33


def assign_dense_ids(
    df: DataFrame, order_by: list[str], id_column: str, start: int = 1
) -> DataFrame:
    """Number all rows start, start + 1, ... in the given order, without a one-task window.

    Rows are range-partitioned and sorted, then written with (partition, position) to the shared
    working folder, so that a lost executor cannot change a number that was already used. The
    rows per partition give one offset per partition; only those offsets meet in one task.
    The order must be total over the rows (unique keys, or whole rows after ``distinct``).
    """
    spark = df.sparkSession
    path = working_path(spark, "ranked")
    place = "_place"
    (
        df.repartitionByRange(*[F.col(name).asc_nulls_last() for name in order_by])
        .sortWithinPartitions(*[F.col(name).asc_nulls_last() for name in order_by])
        .withColumn(place, F.monotonically_increasing_id())
        .write.option("compression", "zstd")
        .parquet(path)
    )
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright(place, POSITION_BITS))

    # One row per range partition: a count bounded by the shuffle width, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col(place).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + position + F.lit(start)).alias(id_column), *df.columns
    )


def surrogate_keys(df: DataFrame, order_by: list[str], id_column: str) -> DataFrame:
    """Dense ids 1..n over the distinct values of the order columns."""
    return assign_dense_ids(df.select(*order_by).distinct(), order_by, id_column)
