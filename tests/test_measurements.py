import json

import pytest
from pyspark.errors import PySparkException

from millrace.plans import measurements
from millrace.sinks.measurements import append_measurements, next_record_id, with_speedup
from millrace.sources.measurements import parse_log, read_log, sorted_records

RUNS = [
    # len_values, k, workers, sequential_time, parallel_time
    (100, 0.2, 1, 4.0, 8.0),
    (100, 0.2, 2, 5.0, 5.0),
    (200, 0.2, 2, 6.0, 2.0),
    (100, 0.7, 1, 4.0, 2.0),
    (100, 0.7, 4, 8.0, 4.0),
]
SCHEMA = "len_values bigint, k double, workers int, sequential_time double, parallel_time double"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = f"file:{tmp_path_factory.mktemp('log')}/log"
    runs = with_speedup(spark.createDataFrame(RUNS, SCHEMA))
    order = ["k", "len_values", "workers"]
    append_measurements(runs.where("k < 0.5"), path, order)
    append_measurements(runs.where("k > 0.5"), path, order)
    return path


def test_ids_start_at_zero_and_go_on(spark, log):
    records = sorted_records(read_log(spark, log)).collect()
    assert [row["record_id"] for row in records] == [0, 1, 2, 3, 4]
    assert [(row["k"], row["len_values"], row["workers"]) for row in records] == sorted(
        (k, n, w) for n, k, w, _, _ in RUNS
    )
    assert next_record_id(spark, log) == 5
    assert next_record_id(spark, f"{log}-none") == 0


def test_single_document_log(spark, tmp_path):
    record = dict(len_values=9, k=0.2, workers=2, sequential_time=1.0, parallel_time=2.0,
                  speedup=0.5, efficiency=0.25)
    (tmp_path / "log.json").write_text(json.dumps({"0": record, "1": {**record, "k": 0.1}}, indent=4))
    rows = sorted_records(read_log(spark, f"file:{tmp_path}/log.json", single_document=True)).collect()
    assert [(row["record_id"], row["k"]) for row in rows] == [(1, 0.1), (0, 0.2)]
    assert dict(rows[0].asDict(), k=0.2, record_id=None) == dict(record, record_id=None)


def test_speedup_and_efficiency(spark):
    row = with_speedup(spark.createDataFrame([(1, 0.2, 4, 8.0, 4.0)], SCHEMA)).first()
    assert (row["speedup"], row["efficiency"]) == (2.0, 0.5)
    row = with_speedup(spark.createDataFrame([(1, 0.2, 4, 8.0, 0.0)], SCHEMA)).first()
    assert (row["speedup"], row["efficiency"]) == (None, None)


def test_rollups(spark, log):
    records = read_log(spark, log)
    means = {row["workers"]: row for row in measurements.mean_metrics(records, "workers").collect()}
    assert means[2]["runs"] == 2 and means[2]["mean_speedup"] == 2.0
    assert means[2]["mean_efficiency"] == 1.0 and means[1]["mean_parallel_time"] == 5.0
    assert measurements.sequential_baseline(records).count() == 2
    best = {row["k"]: row for row in measurements.best_runs(records, "k").collect()}
    assert (best[0.2]["best_len_values"], best[0.2]["best_speedup"]) == (200, 3.0)
    # equal speedups: fewer workers
    assert best[0.7]["best_workers"] == 1
    overall = measurements.best_runs(records).first()
    assert overall["best_speedup"] == 3.0
    profile = {(r["k"], r["len_values"]): r for r in measurements.scaling_profile(records).collect()}
    assert profile[0.2, 100]["baseline_time"] == 4.0
    assert profile[0.7, 100]["worker_counts"] == [1, 4]
    series = measurements.scaling_series(records).collect()
    assert [(r["k"], r["len_values"], r["workers"]) for r in series] == sorted(
        (k, n, w) for n, k, w, _, _ in RUNS
    )


def test_malformed_log_fails_unless_lenient(spark):
    good = '{"1": {"len_values": 5, "k": 0.2, "workers": 2}}'
    df = spark.createDataFrame([(good,), (good[:-4],), ("",)], "value string")
    with pytest.raises(PySparkException):
        parse_log(df).collect()
    assert [r["record_id"] for r in parse_log(df, strict=False).collect()] == [1]
    assert parse_log(df.where("value = ''")).collect() == []


def test_log_stores_little_for_a_run(spark, tmp_path, monkeypatch):
    """The measured values alone are numbered, and the lines are compressed."""
    moved = []
    from millrace.sinks import measurements as sink

    number = sink.assign_dense_ids
    monkeypatch.setattr(
        sink, "assign_dense_ids", lambda df, *rest, **more: moved.append(df.columns) or number(df, *rest, **more)
    )
    runs = spark.range(2000).selectExpr(
        "id AS len_values", "0.2D AS k", "int(id % 4) + 1 AS workers",
        "id / 7D AS sequential_time", "double(id % 3) AS parallel_time",
    )
    append_measurements(runs, f"file:{tmp_path}/log", ["len_values"])
    assert moved == [runs.columns]
    files = list((tmp_path / "log").glob("part-*"))
    assert files and all(file.name.endswith(".gz") for file in files)
    assert sum(file.stat().st_size for file in files) < 2000 * 80
    found = read_log(spark, f"file:{tmp_path}/log").orderBy("record_id").collect()
    expected = with_speedup(runs).orderBy("len_values").collect()
    assert [tuple(row)[1:] for row in found] == [tuple(row) for row in expected]
    assert [row["record_id"] for row in found] == list(range(2000))
