import math

import numpy as np
import pytest
from plans_text import plan_text
from pyspark.sql import functions as F

from millrace.operators.outliers import outlier_stats, outliers
from millrace.sources.generators import uniform_source, uniform_value


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, value double")


def found(spark, values, k):
    return [row["value"] for row in outliers(frame(spark, values), "value", k).orderBy("id").collect()]


def brute_force(values, k):
    data = np.array(values)
    return [x for x in values if abs(x - data.mean()) > k * data.std()]


@pytest.mark.parametrize("k", [-1.0, 0.0, 0.2, 0.7, 2.0, 3.0])
def test_against_brute_force(spark, k):
    values = np.random.default_rng(1).uniform(-1000, 1000, 500).round(3).tolist()
    assert found(spark, values, k) == brute_force(values, k)


def test_duplicates_and_order_are_kept(spark):
    assert found(spark, [100.0, 0.0, 0.0, 100.0, 0.0, 0.0, 0.0], 1.0) == [100.0, 100.0]


def test_value_on_the_threshold_is_no_outlier(spark):
    # mean 0, deviation 1: both values are exactly one deviation away
    assert found(spark, [-1.0, 1.0], 1.0) == []
    assert found(spark, [-1.0, 1.0], 0.99) == [-1.0, 1.0]


@pytest.mark.parametrize("values", [[], [5.0], [0.1] * 7, [1.0, math.nan, 9.0], [1.0, math.inf, 2.0]])
@pytest.mark.parametrize("k", [0.0, 0.5])
def test_inputs_without_outliers(spark, values, k):
    assert found(spark, values, k) == []


def test_nulls_are_neither_counted_nor_found(spark):
    assert found(spark, [None, 1.0, 1.0, 1.0, 9.0, None], 1.0) == [9.0]


def test_stats_of_an_empty_input_are_null(spark):
    row = outlier_stats(frame(spark, []), "value", 2.0).first()
    assert row["row_count"] == 0
    assert (row["mean"], row["deviation"], row["threshold"]) == (None, None, None)


def test_population_deviation(spark):
    row = outlier_stats(frame(spark, [2.0, 4.0, 4.0, 4.0, 5.0, 5.0, 7.0, 9.0]), "value", 1.5).first()
    assert (row["mean"], row["deviation"], row["threshold"]) == (5.0, 2.0, 3.0)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_result_does_not_depend_on_partitions(spark, partitions):
    df = uniform_source(spark, 2000)
    expected = outliers(df, "value", 1.2).orderBy("id").collect()
    assert outliers(df.repartition(partitions), "value", 1.2).orderBy("id").collect() == expected


def test_outliers_and_rest_are_the_input(spark):
    df = uniform_source(spark, 1000)
    out = outliers(df, "value", 1.0)
    rest = df.join(out.select("id"), "id", "left_anti")
    assert out.count() + rest.count() == 1000
    assert out.agg(F.min(F.abs("value"))).first()[0] > rest.agg(F.max(F.abs("value"))).first()[0] - 30


def test_plan_filters_by_one_subquery_without_a_join(spark, small):
    df = spark.read.parquet(f"{small}/events.parquet").select("event_id", "value")
    text = plan_text(outliers(df, "value", 2.0), executed=True)
    assert "Join" not in text and "Python" not in text
    assert text.count("ReusedSubquery") == 1
    assert "ReadSchema: struct<value:double>" in text


def test_uniform_source_is_repeatable_and_uniform(spark):
    one, seven = (
        spark.range(0, 5000, 1, parts).select("id", uniform_value("id").alias("v")).orderBy("id")
        for parts in (1, 7)
    )
    assert one.collect() == seven.collect()
    row = one.agg(F.avg("v"), F.stddev_pop("v"), F.min("v"), F.max("v")).first()
    assert abs(row[0]) < 30 and abs(row[1] - 2000 / math.sqrt(12)) < 15
    assert -1000 <= row[2] < -990 and 990 < row[3] < 1000
    other = spark.range(100).select(uniform_value("id", seed=7)).collect()
    assert other != spark.range(100).select(uniform_value("id")).collect()
