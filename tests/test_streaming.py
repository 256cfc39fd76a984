import json

import pytest
from plans_text import plan_text
from pyspark.sql import functions as F

from millrace.sources.external import read_message_stream
from millrace.streaming.messages import (
    EVENT_COLUMNS,
    Rules,
    batch_stats,
    classify_quality,
    flag_anomalies,
    flatten_messages,
    parse_messages,
    register_classifier,
    replay,
)
from millrace.streaming.pipeline import (
    DatabaseSinks,
    FileSinks,
    merged_stats,
    start_stream,
    write_micro_batch,
)

SCHEMA = "key string, value string, timestamp timestamp"
FULL = {
    "fixed_acidity": 7.4,
    "volatile_acidity": 0.7,
    "citric_acid": 0.0,
    "residual_sugar": 1.9,
    "chlorides": 0.076,
    "free_sulfur_dioxide": 11.0,
    "total_sulfur_dioxide": 34.0,
    "density": 0.9978,
    "pH": 3.51,
    "sulphates": 0.56,
    "alcohol": 9.4,
    "quality": 5,
}


def message(**changes):
    body = {**FULL, **changes}
    return json.dumps({name: value for name, value in body.items() if value is not ...})


def batch(spark, *values):
    rows = [(str(at), value, None) for at, value in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("value", F.col("value").cast("binary")).withColumn(
        "timestamp", F.lit("2025-01-01 00:00:00").cast("timestamp")
    )


def sinks(tmp_path):
    return FileSinks(f"file:{tmp_path}/out")


@pytest.mark.parametrize(
    "grade, group", [(None, "unknown"), (0, "low"), (4, "low"), (5, "medium"), (6, "medium"), (7, "high")]
)
def test_classifier_as_column_and_in_sql(spark, grade, group):
    register_classifier(spark)
    df = spark.createDataFrame([(grade,)], "quality int")
    both = df.select(
        classify_quality("quality").alias("a"), F.expr("classify_quality(quality)").alias("b")
    )
    assert tuple(both.first()) == (group, group)
    assert "Python" not in plan_text(both)


@pytest.mark.parametrize("value, anomaly", [(1.0, False), (1.01, True), (None, False)])
def test_anomaly_flag(spark, value, anomaly):
    row = flag_anomalies(spark.createDataFrame([(value,)], "sulphates double")).first()
    assert row["is_anomaly"] is anomaly
    assert row["anomaly_reason"] == ("sulphates > 1.0" if anomaly else None)


@pytest.mark.parametrize(
    "text",
    [
        "not json", "", "null", message(quality=5.0), message(quality="6"),
        message(quality=None), message(quality=...),
    ],
)
def test_messages_without_a_whole_grade_are_dropped(spark, text):
    assert parse_messages(batch(spark, text)).isEmpty()


def test_known_message(spark):
    row = parse_messages(batch(spark, message())).first().asDict()
    assert row["ph"] == 3.51 and row["quality_group"] == "medium" and not row["is_anomaly"]
    assert row["fixed_acidity"] == 7.4 and str(row["kafka_timestamp"]) == "2025-01-01 00:00:00"


def test_wrong_types_and_names_give_null_fields(spark):
    rows = flatten_messages(
        batch(
            spark,
            message(fixed_acidity="7.4"),
            message(fixed_acidity="abc"),
            message(pH=..., ph=3.0),
        )
    ).collect()
    assert [row["fixed_acidity"] for row in rows] == [None, None, 7.4]
    assert rows[2]["ph"] is None and all(row["quality"] == 5 for row in rows)


def test_parsing_stays_in_the_jvm(spark):
    assert "Python" not in plan_text(parse_messages(batch(spark, message())))


def test_micro_batch_outputs(spark, tmp_path):
    out = sinks(tmp_path)
    rows = batch(
        spark,
        message(quality=4), message(quality=5), message(quality=6), message(quality=7),
        message(quality=6, sulphates=1.56), message(quality=3, sulphates=1.28),
        message(quality=6, sulphates=1.0, alcohol=12.0),
        message(quality=8, sulphates=None, pH="x"),
        "not json",
    )
    write_micro_batch(flatten_messages(rows), 3, out)
    events = out.read(spark, "events")
    assert events.columns == [*EVENT_COLUMNS, "batch_id"]
    assert sorted((r["quality"], r["quality_group"]) for r in events.collect()) == [
        (6, "medium"), (6, "medium"), (7, "high"),
    ]
    anomalies = out.read(spark, "anomalies").orderBy("sulphates").collect()
    assert [row["sulphates"] for row in anomalies] == [1.28, 1.56]
    assert anomalies[0]["log_line"].startswith('[ANOMALY] batch_id=3; data={"fixed_acidity":7.4')
    assert anomalies[0]["anomaly_reason"] == "sulphates > 1.0"
    rejects = out.read(spark, "rejects").collect()
    assert sorted(row["violated"] for row in rejects) == ["ph", "sulphates"]
    stats = {row["quality_group"]: row for row in out.read(spark, "stats").collect()}
    assert stats["medium"]["row_count"] == 2 and stats["medium"]["batch_id"] == 3
    assert stats["medium"]["avg_alcohol"] == pytest.approx(10.7)
    assert stats["high"]["min_ph"] == 3.51


def test_repeated_batch_leaves_the_sinks_unchanged(spark, tmp_path):
    out = sinks(tmp_path)
    first = flatten_messages(batch(spark, message(quality=6), message(quality=9, sulphates=2.0)))
    second = flatten_messages(batch(spark, message(quality=7)))
    write_micro_batch(first, 0, out)
    write_micro_batch(second, 1, out)
    before = {n: sorted(map(repr, out.read(spark, n).drop("processed_at", "calculated_at").collect()))
              for n in ("events", "stats", "anomalies")}
    write_micro_batch(first, 0, out)
    after = {n: sorted(map(repr, out.read(spark, n).drop("processed_at", "calculated_at").collect()))
             for n in ("events", "stats", "anomalies")}
    assert before == after and len(before["events"]) == 2 and len(before["anomalies"]) == 1


def test_empty_batches_write_nothing(spark, tmp_path):
    out = sinks(tmp_path)
    write_micro_batch(flatten_messages(batch(spark, "not json").limit(0)), 0, out)
    assert not (tmp_path / "out").exists()
    write_micro_batch(flatten_messages(batch(spark, message(quality=3))), 1, out)
    assert out.read(spark, "events").isEmpty() and out.read(spark, "stats").isEmpty()


def test_stored_batch_is_released_when_a_write_fails(spark):
    class Broken:
        def write(self, name, rows, batch_id):
            raise RuntimeError("sink is down")

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(RuntimeError, match="sink is down"):
        write_micro_batch(flatten_messages(batch(spark, message(quality=6))), 0, Broken())
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_stream_over_several_files_and_a_restart(spark, tmp_path):
    source, progress = tmp_path / "in", f"file:{tmp_path}/progress"
    out = sinks(tmp_path)

    def put(name, *lines):
        source.mkdir(exist_ok=True)
        body = "".join(
            json.dumps({"key": "k", "value": line, "timestamp": "2025-01-01T00:00:00Z"}) + "\n"
            for line in lines
        )
        (source / name).write_text(body)

    def run():
        stream = read_message_stream(
            spark, "json", schema=SCHEMA, path=f"file:{source}", maxFilesPerTrigger="1"
        )
        start_stream(stream, out, progress, available_now=True).awaitTermination()

    put("a.json", message(quality=6), message(quality=4), message(quality=7, alcohol=11.0))
    put("b.json")
    put("c.json", message(quality=7, alcohol=13.0), "broken", message(quality=6, sulphates=1.5))
    run()
    run()
    assert out.read(spark, "events").count() == 3
    put("d.json", message(quality=8, alcohol=15.0, pH=3.0))
    run()
    events = out.read(spark, "events")
    assert events.count() == 4 and events.select("batch_id").distinct().count() == 3
    merged = {r["quality_group"]: r for r in merged_stats(out.read(spark, "stats")).collect()}
    assert merged["high"]["row_count"] == 3
    assert merged["high"]["avg_alcohol"] == pytest.approx(13.0)
    assert (merged["high"]["min_ph"], merged["high"]["max_ph"]) == (3.0, 3.51)


def test_batch_stats_columns(spark):
    stats = batch_stats(parse_messages(batch(spark, message())), 5)
    assert stats.columns == [
        "batch_id", "quality_group", "row_count", "avg_alcohol", "avg_volatile_acidity",
        "min_ph", "max_ph", "calculated_at",
    ]


def test_rules_are_adjustable(spark, tmp_path):
    rules = Rules(sulphates=0.5, low=5, medium=8, min_quality=1)
    row = parse_messages(batch(spark, message()), rules).first()
    assert row["is_anomaly"] and row["quality_group"] == "low"
    assert row["anomaly_reason"] == "sulphates > 0.5"


def test_replay_repeats_every_message(spark):
    rows = replay(batch(spark, "a", "b"), 3)
    assert rows.count() == 6 and rows.groupBy("round").count().count() == 3


def test_database_sinks_send_only_their_tables(spark, tmp_path, monkeypatch):
    sent, deleted = [], []
    monkeypatch.setattr(
        "millrace.streaming.pipeline.write_jdbc",
        lambda rows, url, table, properties: sent.append((url, table, rows.count(), properties)),
    )
    monkeypatch.setattr(
        "millrace.streaming.pipeline.delete_batch",
        lambda spark, url, table, batch_id, properties: deleted.append((table, batch_id, len(sent))),
    )
    files = sinks(tmp_path)
    target = DatabaseSinks(
        "jdbc:x", {"events": "wine_events", "stats": "wine_quality_stats"}, {"user": "u"}, files
    )
    write_micro_batch(flatten_messages(batch(spark, message(quality=6))), 0, target)
    assert [item[:3] for item in sent] == [
        ("jdbc:x", "wine_events", 1), ("jdbc:x", "wine_quality_stats", 1),
    ]
    assert deleted == [("wine_events", 0, 0), ("wine_quality_stats", 0, 1)]
    assert not (tmp_path / "out" / "events").exists()


def test_repeated_batch_without_rows_leaves_none(spark, tmp_path):
    store = sinks(tmp_path)
    rows = spark.createDataFrame([(1.0,)], "ph double")
    store.write("stats", rows, 4)
    store.write("stats", rows, 5)
    store.write("stats", rows.where("ph > 5"), 4)
    assert [r["batch_id"] for r in store.read(spark, "stats").collect()] == [5]


def test_missing_root_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        FileSinks(f"file:{tmp_path}/nowhere").read(spark, "events")


def test_stream_queries_read_the_events_table_only(spark, small, tmp_path):
    """A folder as table, files without suffix, and a sibling with a similar name."""
    import shutil

    from millrace.registry import QUERIES

    (tmp_path / "events.parquet").mkdir()
    shutil.copy(f"{small}/events.parquet", tmp_path / "events.parquet" / "part-1")
    shutil.copy(f"{small}/events.parquet", tmp_path / "events.parquet_old.parquet")
    expected = sorted(map(tuple, QUERIES["stream_events"](spark, small).collect()), key=str)
    found = QUERIES["stream_events"](spark, f"file:{tmp_path}")
    assert sorted(map(tuple, found.collect()), key=str) == expected
