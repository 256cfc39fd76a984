"""Repeatable random columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEX_DIGITS = 12


def uniform_value(key: Column | str, seed: int = 42, low: float = -1000.0, high: float = 1000.0) -> Column:
    """Uniform double in [low, high) from a key and a seed.

    It depends on nothing but the key and the seed: any partitioning, any re-run of a lost task
    and any engine with MD5 gives the same value.
    """
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint")
    share = number.cast("double") / F.lit(float(16**HEX_DIGITS))
    return F.lit(low) + F.lit(high - low) * share


def uniform_source(
    spark: SparkSession, rows: int, seed: int = 42, low: float = -1000.0, high: float = 1000.0
) -> DataFrame:
    return spark.range(rows).select("id", uniform_value("id", seed, low, high).alias("value"))
