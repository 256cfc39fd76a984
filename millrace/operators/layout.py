"""Physical placement of tables: hash distribution by a key, co-location, hot keys, statistics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import setting


@dataclass(frozen=True)
class Placed:
    """A table as stored: rows bucketed by their key, and rows of hot keys kept apart.

    A bucket is read by one task, so a key with more rows than a bucket should have cannot be in
    one. Its rows are in ``hot``, spread evenly and free of buckets. ``hot`` is None when the
    table has no such key.
    """

    regular: DataFrame
    hot: DataFrame | None = None

    def transform(self, step: Callable[[DataFrame], DataFrame]) -> Placed:
        """The same row-wise step or dimension join on both parts."""
        return Placed(step(self.regular), None if self.hot is None else step(self.hot))

    def rows(self) -> DataFrame:
        """All rows as one table."""
        return self.regular if self.hot is None else self.regular.unionByName(self.hot)


def hot_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows, null included. There are fewer than rows / limit."""
    return (
        df.groupBy(F.col(key).alias("hot_key"))
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > limit)
        .select("hot_key")
    )


def write_hot_keys(df: DataFrame, key: str, buckets: int, path: str) -> DataFrame | None:
    """Store the keys that hold more rows than an average bucket; None when there are none.

    The limit is rows / buckets, so the stored list has fewer than ``buckets`` entries.
    """
    limit = max(1, df.count() // buckets)
    hot_keys(df, key, limit).write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return None if stored.isEmpty() else stored


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write a catalog table hashed by the key into one file per bucket, sorted by the key."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


def write_placed(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int,
    path: str,
    hot: DataFrame | None = None,
) -> Placed:
    """Write a table distributed by a key, with the rows of the given hot keys kept apart."""
    if hot is None:
        return Placed(write_bucketed(df, table, key, buckets, f"{path}/{table}"))
    # The list has fewer entries than there are buckets (see write_hot_keys).
    small = F.broadcast(hot)
    match = F.col(key).eqNullSafe(F.col("hot_key"))
    regular = write_bucketed(
        df.join(small, match, "left_anti"), table, key, buckets, f"{path}/{table}"
    )
    df.join(small, match, "left_semi").write.mode("overwrite").parquet(f"{path}/{table}_hot")
    return Placed(regular, df.sparkSession.read.parquet(f"{path}/{table}_hot"))


def colocate(
    facts: DataFrame,
    fact_table: str,
    fact_key: str,
    owners: DataFrame,
    owner_table: str,
    owner_key: str,
    buckets: int,
    path: str,
) -> tuple[Placed, Placed]:
    """Place two tables by their join key, so that joining them moves no rows.

    Both use the same bucket count and the same hot-key list, taken from the larger (fact) table.
    """
    hot = write_hot_keys(facts, fact_key, buckets, f"{path}/{fact_table}_hot_keys")
    return (
        write_placed(facts, fact_table, fact_key, buckets, path, hot),
        write_placed(owners, owner_table, owner_key, buckets, path, hot),
    )


def redistribute(
    spark: SparkSession, source: str, target: str, key: str, buckets: int, path: str
) -> Placed:
    """Copy a catalog table under another distribution key, hot keys of that key kept apart."""
    rows = spark.table(source)
    hot = write_hot_keys(rows, key, buckets, f"{path}/{target}_hot_keys")
    return write_placed(rows, target, key, buckets, path, hot)


def create_bucketed(
    spark: SparkSession, table: str, schema: str, key: str, buckets: int, path: str
) -> None:
    """An empty catalog table hashed by the key, to be filled by inserts. ``schema`` is DDL."""
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def collect_statistics(
    spark: SparkSession, table: str, columns: list[str] | None = None, histograms: bool = False
) -> None:
    """Refresh table statistics; for all columns unless some are named.

    With ``histograms``, columns of numbers and times get their distribution too, from one more
    pass, so that the share of rows that a range keeps is known and not taken as even.
    """
    chosen = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    with setting(spark, "spark.sql.statistics.histogram.enabled", str(histograms).lower()):
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {chosen}")


def join_placed(
    left: Placed, right: Placed, left_key: str, right_key: str
) -> list[DataFrame]:
    """Inner join of two tables placed by their join key: one frame per kind of key.

    Regular rows meet bucket by bucket. Hot rows of both sides share one key list, so the two
    parts have no key in common and their union is the whole join.
    """
    pairs = [(left.regular, right.regular)]
    if left.hot is not None and right.hot is not None:
        pairs.append((left.hot, right.hot))
    return [a.join(b, F.col(left_key) == F.col(right_key)) for a, b in pairs]


def union_parts(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
