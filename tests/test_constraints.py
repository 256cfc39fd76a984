from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import constraints, counts


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_null_violations_name_the_column(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "x int, y string")
    assert rows(constraints.null_violations(df, ["x", "y"])) == sorted(
        [(None, "b", "x"), (None, None, "x"), (None, None, "y")], key=repr
    )


def test_duplicate_keys_ignore_nulls(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int"
    )
    assert rows(constraints.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    assert rows(constraints.duplicate_keys(df, ["b"])) == [(1, 4)]


def test_orphan_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "ref int")
    parent = spark.createDataFrame([(1,), (3,), (3,)], "id int")
    assert rows(constraints.orphan_keys(child, parent, {"ref": "id"})) == [(2, 2)]


def test_orphan_keys_over_two_columns(spark):
    child = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    parent = spark.createDataFrame([(1, 1), (2, 2)], "c int, d int")
    assert rows(constraints.orphan_keys(child, parent, {"a": "c", "b": "d"})) == [(1, 2, 1)]


def test_check_passes_unknown(spark):
    df = spark.createDataFrame([(-1,), (0,), (None,)], "grade int")
    assert rows(constraints.expression_violations(df, F.col("grade") >= 0)) == [(-1,)]


def test_type_limits(spark):
    df = spark.createDataFrame(
        [("abc", 999.99), ("abcd", 1000.0), (None, -1000.0)], "t string, n double"
    )
    found = constraints.type_limit_violations(df, {"t": 3}, {"n": T.DecimalType(5, 2)})
    assert rows(found) == sorted(
        [("abcd", 1000.0, "t"), ("abcd", 1000.0, "n"), (None, -1000.0, "n")], key=repr
    )


def test_reconcile_counts(spark):
    expected = spark.createDataFrame(
        [("a", 2), ("b", 3), ("c", 0)], "table_name string, row_count bigint"
    )
    actual = spark.createDataFrame([("a", 2), ("b", 1)], "table_name string, row_count bigint")
    assert rows(constraints.reconcile_counts(actual, expected)) == [
        ("a", 2, 2, True),
        ("b", 3, 1, False),
        ("c", 0, 0, True),
    ]


def test_counts_profiles_and_previews(spark):
    tables = {"b": spark.range(3), "a": spark.createDataFrame([(1, "x")], "n int, t string")}
    assert [tuple(r) for r in counts.row_counts(tables).collect()] == [("a", 1), ("b", 3)]
    assert [tuple(r) for r in counts.table_profile(tables).collect()] == [
        ("a", 1, 2, "n, t"),
        ("b", 3, 1, "id"),
    ]
    assert [r["id"] for r in counts.latest_rows(spark.range(20), "id", 2).collect()] == [19, 18]
    assert [r["id"] for r in counts.sample_rows(spark.range(20), 2, ["id"]).collect()] == [0, 1]
    assert counts.sample_rows(spark.range(3)).count() == 3


def test_range_applies_to_the_rounded_value(spark):
    df = spark.createDataFrame([(999.996,), (999.994,), (-1000.0,), (None,)], "x double")
    broken = constraints.type_limit_violations(df, numerics={"x": T.DecimalType(5, 2)})
    assert sorted(r["x"] for r in broken.collect()) == [-1000.0, 999.996]
