"""Rollups of a measurement log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ["sequential_time", "parallel_time", "speedup", "efficiency"]


def sequential_baseline(records: DataFrame) -> DataFrame:
    """The one-worker records, which carry the sequential time to compare with."""
    return records.where(F.col("workers") == 1)


def mean_metrics(records: DataFrame, *keys: str) -> DataFrame:
    """Number of runs and mean of every metric per combination of the given fields."""
    means = [F.avg(name).alias(f"mean_{name}") for name in METRICS]
    return records.groupBy(*keys).agg(F.count("*").alias("runs"), *means)


def best_runs(records: DataFrame, *keys: str) -> DataFrame:
    """The run with the highest speedup per group; equal speedups prefer fewer workers, then the
    smaller input and the smaller k."""
    rank = F.struct("speedup", -F.col("workers"), -F.col("len_values"), -F.col("k"))
    run = F.struct("len_values", "k", "workers", "speedup", "efficiency")
    picked = records.groupBy(*keys).agg(F.max_by(run, rank).alias("best"))
    return picked.select(*keys, *[F.col(f"best.{name}").alias(f"best_{name}") for name in
                                  ("len_values", "k", "workers", "speedup", "efficiency")])


def scaling_profile(records: DataFrame) -> DataFrame:
    """Per k and input size: the baseline time of the smallest worker count and the worker
    counts that were measured."""
    first = F.struct("workers", "sequential_time")
    return records.groupBy("k", "len_values").agg(
        F.min_by("sequential_time", first).alias("baseline_time"),
        F.array_sort(F.collect_set("workers")).alias("worker_counts"),
    )


def scaling_series(records: DataFrame) -> DataFrame:
    """All records in curve order: one curve per k and input size, points by worker count."""
    return records.select("k", "len_values", "workers", *METRICS).orderBy(
        "k", "len_values", "workers", *METRICS
    )
