"""The message stream over the events table.

Every event becomes a row of the wine file (text columns), then a JSON message, and the messages
are read as a file stream. Grade = the number in props; error events carry no sulphates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import row_json
from millrace.operators.manifest import normalize_fields
from millrace.registry.common import Inputs, query, sql_round
from millrace.sinks.messages import to_messages, write_messages
from millrace.sources.external import read_message_stream
from millrace.sources.schemas import WINE_FIELDS, WINE_MESSAGE
from millrace.streaming.messages import Rules, classify_quality, register_classifier, replay
from millrace.streaming.pipeline import FileSinks, Sinks, merged_stats, start_stream
from millrace.streaming.recovery import FailingSinks, Progress, SinkDown, progress, repeat_last_batch
from millrace.streaming.rounds import Rounds, sent_times

RULES = Rules(sulphates=150.0, low=40, medium=60, min_quality=60)

MESSAGE_SCHEMA = "key string, value binary, timestamp timestamp"
# Micro-batches that the stored messages are read in.
BATCHES = 4


def _grade():
    return F.get_json_object("props", "$.k").cast("int")


def wine_rows(events: DataFrame, *keep: str) -> DataFrame:
    """Events as rows of the wine file: one text column per CSV header name."""
    value, user, grade = F.col("value"), F.col("user_id"), F.col("_grade")
    numbers = {
        "fixed acidity": value / 10,
        "volatile acidity": grade / 100,
        "citric acid": user / 100,
        "residual sugar": value,
        "chlorides": grade / 1000,
        "free sulfur dioxide": user,
        "total sulfur dioxide": user + grade,
        "density": value / 1000,
        "pH": grade / 200 + 3,
        "sulphates": F.when(F.col("event_type") != "error", value),
        "alcohol": value / 50 + 8,
        "quality": grade,
    }
    columns = [number.cast("string").alias(name) for name, number in numbers.items()]
    # The grade is a column of its own, so that the JSON text is read once per event.
    return events.withColumn("_grade", _grade()).select(*keep, *columns)


def wine_messages(events: DataFrame) -> DataFrame:
    """Events as messages with key, binary value and timestamp."""
    rows = normalize_fields(wine_rows(events, "event_id", "ts"), WINE_FIELDS, keep=("event_id", "ts"))
    return rows.select(
        F.col("event_id").cast("string").alias("key"),
        row_json(*WINE_FIELDS.values()).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


FIELDS_SQL = """
    SELECT event_id, ts, event_type, k,
           value / 10 AS fixed_acidity, k / 100 AS volatile_acidity, user_id / 100 AS citric_acid,
           value AS residual_sugar, k / 1000 AS chlorides,
           CAST(user_id AS DOUBLE) AS free_sulfur_dioxide,
           CAST(user_id + k AS DOUBLE) AS total_sulfur_dioxide, value / 1000 AS density,
           k / 200 + 3 AS ph,
           CASE WHEN event_type <> 'error' THEN value END AS sulphates,
           value / 50 + 8 AS alcohol, k AS quality
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events) AS graded
"""

GROUP_SQL = f"""CASE WHEN quality IS NULL THEN 'unknown' WHEN quality <= {RULES.low} THEN 'low'
            WHEN quality <= {RULES.medium} THEN 'medium' ELSE 'high' END"""

KEPT_SQL = f"""
    SELECT * FROM ({FIELDS_SQL}) AS fields
    WHERE NOT coalesce(sulphates > {RULES.sulphates}, FALSE) AND quality >= {RULES.min_quality}
"""

MEASURES_SQL = """fixed_acidity, volatile_acidity, citric_acid, residual_sugar, chlorides,
       free_sulfur_dioxide, total_sulfur_dioxide, density, ph, sulphates, alcohol, quality"""


def _stored_messages(data: Inputs, path: str) -> DataFrame:
    """The events as message files below a path, read as a stream in BATCHES batches."""
    files = max(BATCHES, data.width)
    wine_messages(data["events"]).repartition(files, "key").write.parquet(f"{path}/in")
    return read_message_stream(
        data.spark,
        "parquet",
        schema=MESSAGE_SCHEMA,
        path=f"{path}/in",
        maxFilesPerTrigger=str(-(-files // BATCHES)),
    )


def _run(messages: DataFrame, sinks: Sinks, path: str) -> None:
    started = start_stream(messages, sinks, f"{path}/progress", RULES, available_now=True)
    started.awaitTermination()


def run_stream(data: Inputs) -> FileSinks:
    """Store the events as message files, then run the job over these until all are read.

    The messages come from the events table itself, whatever else lies in its folder.
    """
    data["events"]

    def build(path: str) -> FileSinks:
        sinks = FileSinks(f"{path}/out")
        _run(_stored_messages(data, path), sinks, path)
        return sinks

    return data.stored("stream", build)


def run_stopped_stream(data: Inputs) -> FileSinks:
    """The same job, broken off between two outputs of its second batch, started again from its
    logs, and with its last batch repeated after the end."""
    data["events"]

    def build(path: str) -> FileSinks:
        messages = _stored_messages(data, path)
        sinks = FileSinks(f"{path}/out")
        failing = FailingSinks(sinks, batch_id=1, output="events")
        try:
            _run(messages, failing, path)
        except StreamingQueryException as error:
            if SinkDown.__name__ not in str(error):
                raise
        state = progress(data.spark, f"{path}/progress")
        if state != Progress(planned=1, committed=0) or sinks.finished(data.spark) != 0:
            raise RuntimeError(f"the job should have stopped inside its second batch: {state}")
        _run(messages, sinks, path)
        last = repeat_last_batch(data.spark, f"{path}/progress")
        _run(messages, sinks, path)
        if progress(data.spark, f"{path}/progress") != Progress(last, last):
            raise RuntimeError(f"batch {last} was not repeated")
        return sinks

    return data.stored("stopped-stream", build)


Run = Callable[[Inputs], FileSinks]


def _without_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


def stream_events(data: Inputs, run: Run = run_stream) -> DataFrame:
    rows = run(data).read(data.spark, "events", whole_batches=True).drop("processed_at", "batch_id")
    return _without_zone(rows)


STREAM_EVENTS_SQL = f"""
SELECT {MEASURES_SQL}, {GROUP_SQL} AS quality_group, ts AS kafka_timestamp
FROM ({KEPT_SQL}) AS kept
WHERE sulphates IS NOT NULL
"""


def stream_rejects(data: Inputs, run: Run = run_stream) -> DataFrame:
    rows = run(data).read(data.spark, "rejects", whole_batches=True).drop("batch_id")
    return _without_zone(rows)


STREAM_REJECTS_SQL = f"""
SELECT {MEASURES_SQL}, {GROUP_SQL} AS quality_group, ts AS kafka_timestamp,
       'sulphates' AS violated
FROM ({KEPT_SQL}) AS kept
WHERE sulphates IS NULL
"""


def stream_stats(data: Inputs, run: Run = run_stream) -> DataFrame:
    """Per-batch statistics merged over all batches, as batch bounds depend on the trigger."""
    merged = merged_stats(run(data).read(data.spark, "stats", whole_batches=True))
    return merged.select(
        "quality_group",
        "row_count",
        F.round(F.col("avg_alcohol").cast("decimal(38,10)"), 6).cast("double").alias("avg_alcohol"),
        F.round(F.col("avg_volatile_acidity").cast("decimal(38,10)"), 6)
        .cast("double")
        .alias("avg_volatile_acidity"),
        "min_ph",
        "max_ph",
    )


STREAM_STATS_SQL = f"""
SELECT {GROUP_SQL} AS quality_group, count(*) AS row_count,
       {sql_round("avg(alcohol)", 6)} AS avg_alcohol,
       {sql_round("avg(volatile_acidity)", 6)} AS avg_volatile_acidity,
       min(ph) AS min_ph, max(ph) AS max_ph
FROM ({KEPT_SQL}) AS kept
WHERE sulphates IS NOT NULL
GROUP BY {GROUP_SQL}
"""


def stream_anomalies(data: Inputs, run: Run = run_stream) -> DataFrame:
    rows = run(data).read(data.spark, "anomalies", whole_batches=True)
    line_ok = F.col("log_line").startswith("[ANOMALY] batch_id=")
    return _without_zone(
        rows.withColumn("has_log_line", line_ok).drop("log_line", "batch_id")
    )


STREAM_ANOMALIES_SQL = f"""
SELECT fixed_acidity, volatile_acidity, sulphates, alcohol, quality, ts AS kafka_timestamp,
       'sulphates > {RULES.sulphates}' AS anomaly_reason, TRUE AS has_log_line
FROM ({FIELDS_SQL}) AS fields
WHERE sulphates > {RULES.sulphates}
"""


def messages_out(data: Inputs) -> DataFrame:
    """Numbered JSON messages of all events, parsed back to compare their fields."""
    rows = normalize_fields(
        wine_rows(data["events"], "event_id"), WINE_FIELDS, keep=("event_id",)
    )
    messages = to_messages(rows, ["event_id"], drop_order=True)
    parsed = messages.select("key", F.from_json("value", WINE_MESSAGE).alias("body"))
    return parsed.select(
        "key",
        *[F.col(f"body.{name}").alias(name.lower()) for name in WINE_MESSAGE.fieldNames()],
    )


MESSAGES_OUT_SQL = f"""
SELECT CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR) AS key, {MEASURES_SQL}
FROM ({FIELDS_SQL}) AS fields
"""


def classify(data: Inputs) -> DataFrame:
    """The classifier as a column expression and as a SQL function."""
    register_classifier(data.spark, rules=RULES)
    graded = data["events"].select("event_id", _grade().alias("quality"))
    return graded.select(
        "event_id",
        "quality",
        classify_quality("quality", RULES).alias("quality_group"),
        F.expr("classify_quality(quality)").alias("quality_group_sql"),
    )


CLASSIFY_SQL = f"""
SELECT event_id, quality, {GROUP_SQL} AS quality_group, {GROUP_SQL} AS quality_group_sql
FROM ({FIELDS_SQL}) AS fields
"""

def replayed_messages(data: Inputs) -> DataFrame:
    """The messages of all events sent twice: how often each key and value was sent."""
    sent = replay(wine_messages(data["events"]), 2)
    return sent.groupBy("key").agg(
        F.count("*").alias("times"), F.countDistinct("value").alias("bodies")
    )


REPLAYED_MESSAGES_SQL = """
SELECT CAST(event_id AS VARCHAR) AS key, 2 AS times, 1 AS bodies FROM events
"""



def published_messages(data: Inputs) -> DataFrame:
    """Numbered messages published to a sink and read back by a stream, as its receiver sees them."""
    rows = normalize_fields(wine_rows(data["events"], "event_id"), WINE_FIELDS, keep=("event_id",))

    def build(path: str) -> str:
        write_messages(to_messages(rows, ["event_id"], drop_order=True), "json", path=f"{path}/topic")
        received = read_message_stream(data.spark, "json", schema="key string, value string", path=f"{path}/topic")
        copy = received.writeStream.format("parquet").option("checkpointLocation", f"{path}/progress")
        copy.trigger(availableNow=True).start(f"{path}/received").awaitTermination()
        return f"{path}/received"

    received = data.spark.read.parquet(data.stored("published", build))
    parsed = received.select("key", F.from_json("value", WINE_MESSAGE).alias("body"))
    return parsed.select(
        "key",
        *[F.col(f"body.{name}").alias(name.lower()) for name in WINE_MESSAGE.fieldNames()],
    )


ROUNDS = 3


def replayed_stream(data: Inputs) -> DataFrame:
    """All events sent in rounds to a running stream, one round after the other."""
    messages = wine_messages(data["events"])

    def build(path: str) -> Rounds:
        rounds = Rounds(data.spark, path, MESSAGE_SCHEMA, files=max(BATCHES, data.width), per_batch=2)
        rounds.run(messages, ROUNDS)
        return rounds

    return sent_times(data.stored("rounds", build).counts())


REPLAYED_STREAM_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS key, {ROUNDS} AS times, 1 AS bodies, {ROUNDS} AS batches FROM events
"""

QUERIES = {
    "published_messages": query(published_messages),
    "replayed_messages": query(replayed_messages),
    "replayed_stream": query(replayed_stream),
    "recovered_events": query(lambda data: stream_events(data, run_stopped_stream)),
    "recovered_rejects": query(lambda data: stream_rejects(data, run_stopped_stream)),
    "recovered_stats": query(lambda data: stream_stats(data, run_stopped_stream)),
    "recovered_anomalies": query(lambda data: stream_anomalies(data, run_stopped_stream)),
    "stream_events": query(stream_events),
    "stream_rejects": query(stream_rejects),
    "stream_stats": query(stream_stats),
    "stream_anomalies": query(stream_anomalies),
    "messages_out": query(messages_out),
    "classify": query(classify),
}

ORACLES = {
    "published_messages": MESSAGES_OUT_SQL,
    "replayed_messages": REPLAYED_MESSAGES_SQL,
    "replayed_stream": REPLAYED_STREAM_SQL,
    "recovered_events": STREAM_EVENTS_SQL,
    "recovered_rejects": STREAM_REJECTS_SQL,
    "recovered_stats": STREAM_STATS_SQL,
    "recovered_anomalies": STREAM_ANOMALIES_SQL,
    "stream_events": STREAM_EVENTS_SQL,
    "stream_rejects": STREAM_REJECTS_SQL,
    "stream_stats": STREAM_STATS_SQL,
    "stream_anomalies": STREAM_ANOMALIES_SQL,
    "messages_out": MESSAGES_OUT_SQL,
    "classify": CLASSIFY_SQL,
}
