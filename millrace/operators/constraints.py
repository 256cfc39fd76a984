"""Constraint checks. Each returns the violations as rows; no rows means the table is clean."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in a required column, once per such column, in a single scan."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in columns])
    )
    return df.withColumn("violated", F.explode(missing))


def has_no_nulls(columns: list[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; keys with a null never clash."""
    return (
        df.where(has_no_nulls(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def orphan_keys(
    child: DataFrame, parent: DataFrame, keys: Mapping[str, str]
) -> DataFrame:
    """Child keys without a parent, with their number of rows; null keys refer to nothing.

    Both sides are reduced to distinct keys before the join, so a key that fills a third of the
    child is one row by then.
    """
    child_keys = list(keys)
    referenced = child.where(has_no_nulls(child_keys)).groupBy(*child_keys).agg(
        F.count("*").alias("row_count")
    )
    existing = parent.select(
        *[F.col(column).alias(name) for name, column in keys.items()]
    ).distinct()
    return referenced.join(existing, child_keys, "left_anti")


def expression_violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the check is false; an unknown (null) result passes, as in SQL."""
    return df.where(~condition)


def too_long(column: str, limit: int) -> Column:
    """Violation test of a VARCHAR(limit) column."""
    return F.length(F.col(column)) > limit


def out_of_range(column: str, precision: int, scale: int) -> Column:
    """Violation test of a NUMERIC(precision, scale) column: the value as rounded to the scale."""
    return F.abs(F.round(F.col(column), scale)) >= F.lit(float(10 ** (precision - scale)))


def type_limit_violations(
    df: DataFrame,
    lengths: Mapping[str, int] | None = None,
    numerics: Mapping[str, T.DecimalType] | None = None,
) -> DataFrame:
    """Rows that break a declared text length or numeric range, once per column."""
    tests = {name: too_long(name, limit) for name, limit in (lengths or {}).items()}
    for name, kind in (numerics or {}).items():
        tests[name] = out_of_range(name, kind.precision, kind.scale)
    broken = F.array_compact(
        F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()])
    )
    return df.withColumn("violated", F.explode(broken))


def reconcile_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare two (table_name, row_count) tables; a missing table counts as zero rows."""
    left = expected.select("table_name", F.col("row_count").alias("expected_rows"))
    right = actual.select("table_name", F.col("row_count").alias("actual_rows"))
    return left.join(right, "table_name", "left").select(
        "table_name",
        "expected_rows",
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
        (F.col("expected_rows") == F.coalesce("actual_rows", F.lit(0))).alias("matches"),
    )
