import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import (
    cast_column,
    days_late,
    file_name,
    flag,
    is_late,
    labelled,
    parse_json,
    positive_part,
    rate,
    round_half_up,
    rounded_avg,
    row_json,
    safe_ratio,
)


def one(spark, column, schema="x int", row=(0,)):
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "value, digits, expected",
    [(0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0), (1.005, 2, 1.01), (None, 2, None)],
)
def test_round_half_up(spark, value, digits, expected):
    assert one(spark, round_half_up("x", digits), "x double", (value,)) == expected


def test_rate_counts_null_conditions_as_misses(spark):
    df = spark.createDataFrame([(True,), (None,), (False,), (True,)], "hit boolean")
    assert df.agg(rate(F.col("hit")).alias("r")).first()["r"] == 0.5
    assert [row["f"] for row in df.select(flag(F.col("hit")).alias("f")).collect()] == [1, 0, 0, 1]


def test_safe_ratio_by_zero_is_null_and_leaves_the_average(spark):
    df = spark.createDataFrame([(3.0, 5.0), (4.0, 0.0), (1.0, 5.0)], "a double, b double")
    assert df.agg(rounded_avg(safe_ratio("a", "b"), 3).alias("m")).first()["m"] == 0.4


def test_positive_part(spark):
    df = spark.createDataFrame([(-3,), (0,), (4,)], "x int")
    assert [row[0] for row in df.select(positive_part("x")).collect()] == [0, 0, 4]


@pytest.mark.parametrize(
    "path, name",
    [("a/b/c.txt", "c.txt"), ("c.txt", "c.txt"), ("a/b/", ""), ("", ""), (None, None)],
)
def test_file_name(spark, path, name):
    assert one(spark, file_name("p"), "p string", (path,)) == name


@pytest.mark.parametrize(
    "submitted, late, days",
    [
        (datetime.datetime(2025, 3, 10, 23, 59), False, 0),
        (datetime.datetime(2025, 3, 11, 0, 0), True, 1),
        (datetime.datetime(2025, 3, 8, 12, 0), False, -2),
    ],
)
def test_lateness_compares_dates(spark, submitted, late, days):
    row = (submitted, datetime.date(2025, 3, 10))
    schema = "s timestamp_ntz, d date"
    assert one(spark, is_late("s", "d"), schema, row) is late
    assert one(spark, days_late("s", "d"), schema, row) == days


def test_labelled(spark):
    assert one(spark, labelled("student", "x", "@example.edu"), row=(7,)) == "student7@example.edu"


def test_cast_strict_and_lenient(spark):
    df = spark.createDataFrame([("12",), ("12.5",)], "x string")
    assert [r[0] for r in df.select(cast_column("x", "bigint", strict=False)).collect()] == [
        12,
        None,
    ]
    with pytest.raises(PySparkException):
        df.select(cast_column("x", "bigint")).collect()


@pytest.mark.parametrize("text", ["not json", "", '{"a": "x"}', '{"b": 1}', None])
def test_parse_json_is_permissive(spark, text):
    parsed = one(spark, parse_json("t", "a int"), "t string", (text,))
    assert parsed is None or parsed["a"] is None


def test_row_json_leaves_out_nulls(spark):
    assert one(spark, row_json("a", "b"), "a int, b string", (1, None)) == '{"a":1}'
