"""Global k-sigma outlier filter over one numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outlier_stats(df: DataFrame, column: str, k: float) -> DataFrame:
    """One row: row count, mean, population standard deviation and the distance limit k * sd.

    One pass of mergeable partial aggregates. An empty input gives null statistics. A column of
    equal values has deviation 0 and no limit: summing equal doubles leaves a mean that differs
    from them in the last bit, which must not turn every row into an outlier.
    """
    value = F.col(column).cast("double")
    summary = df.agg(
        F.count(value).alias("row_count"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("deviation"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    varied = F.col("low") < F.col("high")
    return summary.select(
        "row_count",
        "mean",
        F.when(varied, F.col("deviation")).when(~varied, F.lit(0.0)).alias("deviation"),
        F.when(varied, F.lit(float(k)) * F.col("deviation")).alias("threshold"),
    )


def outliers(df: DataFrame, column: str, k: float) -> DataFrame:
    """Rows whose distance to the mean is greater than k standard deviations, all columns kept.

    The two statistics reach the filter as one scalar subquery, so the second pass is a plain
    scan and filter without a join. Row order is that of the input; sort by an id column if needed.
    """
    limits = F.struct("mean", "threshold")
    stats = outlier_stats(df, column, k).select(limits.alias("limits")).scalar()
    distance = F.abs(F.col(column).cast("double") - stats["mean"])
    return df.where(distance > stats["threshold"])
