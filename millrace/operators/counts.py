"""Whole-table counts, profiles and previews."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table, sorted by name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count, column count and column list per table."""
    profiles = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(", ".join(df.columns)).alias("column_names"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles).orderBy("table_name")


def sample_rows(df: DataFrame, rows: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first rows, in the given order or as stored."""
    return df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)


def latest_rows(df: DataFrame, id_column: str, rows: int = 10) -> DataFrame:
    return df.orderBy(F.col(id_column).desc_nulls_last()).limit(rows)
