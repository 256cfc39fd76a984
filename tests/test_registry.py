"""Every registered query against its SQL twin in DuckDB, on whole tables."""

import math

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as entry
from millrace.operators.segments import hash_segment, segment_counts
from millrace.registry.common import Inputs
from millrace.session import DENSE_TASK_BYTES

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, connection, name):
    columns, rows = spark_rows(QUERIES[name](spark, small))
    expected_columns, expected = duck_rows(connection, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, small, name):
    assert not QUERIES[name](spark, small).isEmpty()


def test_every_sql_text_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 25 and rows[0]["course_id"] == 0


def test_hash_segments_cover_the_table(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    rows = segment_counts(orders, "encounters", hash_segment("o_orderkey", 8), 8).collect()
    assert [row["segment_id"] for row in sorted(rows, key=lambda r: r["segment_id"])] == list(range(8))
    assert math.fsum(row["row_count"] for row in rows) == 1500


def test_width_follows_the_tables_of_the_query(spark, small, monkeypatch):
    monkeypatch.setattr("millrace.session.BYTES_PER_SHUFFLE_PARTITION", 1000)
    widths = {}
    for name in ("nation", "lineitem"):
        data = Inputs(spark, small)
        data[name]
        widths[name] = data.width
    assert widths["nation"] < widths["lineitem"]


def test_dense_rows_get_small_tasks(spark, small):
    keys = (
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )

    def settings():
        return [spark.conf.get(key) for key in keys]

    Inputs(spark, small)["lineitem"]
    before = settings()
    data = Inputs(spark, small, task_bytes=10_000)
    data["lineitem"]
    width, split, advisory = settings()
    assert int(width) == -(-data.bytes // 10_000) > int(before[0])
    assert split == "10000" and advisory == "10000b"
    Inputs(spark, small)["lineitem"]
    assert settings() == before


@pytest.mark.parametrize("name", ["experiment_baseline", "grade_distribution", "university_load", "federated_mart"])
def test_queries_that_hold_all_rows_take_small_tasks(spark, small, name):
    QUERIES[name](spark, small)
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == DENSE_TASK_BYTES
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == f"{DENSE_TASK_BYTES}b"
