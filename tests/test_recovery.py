"""Stops, restarts, repeated batches and replayed rounds of the stream job."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from test_streaming import SCHEMA, message

from millrace.sources.external import read_message_stream
from millrace.sources.folders import child_names, delete_path, read_small, write_small
from millrace.streaming.pipeline import FileSinks, start_stream
from millrace.streaming.recovery import FailingSinks, Progress, progress, repeat_last_batch
from millrace.streaming.rounds import Rounds, sent_times

OUTPUTS = ("anomalies", "rejects", "events", "stats")


class Job:
    """Message files, the stream over them and its outputs below one folder."""

    def __init__(self, spark, root, batches=4):
        self.spark, self.root = spark, root
        self.sinks = FileSinks(f"file:{root}/out")
        self.progress = f"file:{root}/progress"
        (root / "in").mkdir()
        for i in range(batches):
            lines = [
                message(quality=6 + i, alcohol=10.0 + i),
                message(quality=7, sulphates=2.0 + i),
                message(quality=8, pH=...),
                message(quality=9, alcohol=20.0 + i),
            ]
            rows = [{"key": f"{i}-{k}", "value": v, "timestamp": "2025-01-01T00:00:00Z"} for k, v in enumerate(lines)]
            file = root / "in" / f"{i}.json"
            file.write_text("".join(json.dumps(r) + "\n" for r in rows))
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # the source reads by age

    def run(self, sinks=None):
        stream = read_message_stream(
            self.spark, "json", schema=SCHEMA, path=f"file:{self.root}/in", maxFilesPerTrigger="1"
        )
        start_stream(stream, sinks or self.sinks, self.progress, available_now=True).awaitTermination()

    def rows(self, whole=False):
        return {
            name: sorted(
                map(repr, self.sinks.read(self.spark, name, whole).drop("processed_at", "calculated_at").collect())
            )
            for name in OUTPUTS
        }


@pytest.fixture
def undisturbed(spark, tmp_path):
    (tmp_path / "plain").mkdir()
    job = Job(spark, tmp_path / "plain")
    job.run()
    return job.rows()


@pytest.fixture
def job(spark, tmp_path):
    (tmp_path / "job").mkdir()
    return Job(spark, tmp_path / "job")


@pytest.mark.parametrize("output", OUTPUTS)
@pytest.mark.parametrize("batch_id", [0, 2])
def test_stop_between_sinks_then_restart(job, undisturbed, spark, output, batch_id):
    failing = FailingSinks(job.sinks, batch_id, output)
    with pytest.raises(StreamingQueryException, match="SinkDown"):
        job.run(failing)
    state = progress(spark, job.progress)
    assert state == Progress(batch_id, batch_id - 1 if batch_id else None) and state.pending == batch_id
    # What is written of the broken batch is there, but no reader of whole batches sees it.
    before = OUTPUTS[: OUTPUTS.index(output)]
    assert [name for at, name in failing.written if at == batch_id] == list(before)
    if before or batch_id:
        whole = job.rows(whole=True)
        assert all(f"batch_id={batch_id}" not in row for rows in whole.values() for row in rows)
        assert len(whole["events"]) == 2 * batch_id
    job.run()
    assert job.rows() == job.rows(whole=True) == undisturbed
    assert progress(spark, job.progress) == Progress(3, 3)


def test_last_batch_can_be_repeated(job, undisturbed, spark):
    job.run()
    delete_path(spark, f"file:{job.root}/out/events/batch_id=3")
    assert len(job.rows()["events"]) == len(undisturbed["events"]) - 2
    assert repeat_last_batch(spark, job.progress) == 3
    assert progress(spark, job.progress).pending == 3
    # Asked again before the next start, nothing more is taken back.
    assert repeat_last_batch(spark, job.progress) == 3
    job.run()
    assert job.rows() == undisturbed and progress(spark, job.progress) == Progress(3, 3)


def test_a_query_that_never_ran(spark, tmp_path):
    assert progress(spark, f"file:{tmp_path}/none") == Progress(None, None)
    assert repeat_last_batch(spark, f"file:{tmp_path}/none") is None


def test_batches_that_fail_again_and_again(job, undisturbed):
    for output in OUTPUTS:
        with pytest.raises(StreamingQueryException):
            job.run(FailingSinks(job.sinks, 1, output))
    job.run()
    assert job.rows() == undisturbed


MESSAGES = "key string, value binary, timestamp timestamp"


def test_rounds_reach_a_running_query_one_after_the_other(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), bytes([i % 3]), None) for i in range(50)], MESSAGES)
    rounds = Rounds(spark, f"file:{tmp_path}", MESSAGES, files=4, per_batch=2)
    rounds.run(rows, 3)
    found = sent_times(rounds.counts()).collect()
    assert len(found) == 50
    assert {(r["times"], r["bodies"], r["batches"]) for r in found} == {(3, 1, 3)}
    # No micro-batch takes more files than admitted: four files make two batches a round or more.
    assert rounds.batches() >= 6
    # A later sender goes on with the same folder, and the query with its log.
    rounds.run(rows, 1)
    assert {r["times"] for r in sent_times(rounds.counts()).collect()} == {4}


def test_rounds_of_repeated_and_unkeyed_messages(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"1", None), ("a", b"2", None), ("a", b"2", None), (None, None, None)], MESSAGES)
    rounds = Rounds(spark, f"file:{tmp_path}", MESSAGES, files=1, per_batch=1)
    rounds.run(rows, 2)
    found = {r["key"]: (r["times"], r["bodies"], r["batches"]) for r in sent_times(rounds.counts()).collect()}
    assert found == {"a": (6, 2, 2), None: (2, 1, 2)}
    empty = Rounds(spark, f"file:{tmp_path}/empty", MESSAGES)
    empty.run(rows.limit(0), 2)
    assert empty.batches() == 0 and sent_times(empty.counts()).isEmpty()


def test_small_files_are_replaced_as_a_whole(spark, tmp_path):
    path = f"file:{tmp_path}/pointer"
    assert read_small(spark, path) is None
    for text in ("one", "zwei ü", ""):
        write_small(spark, path, text)
        assert read_small(spark, path) == text
    assert child_names(spark, f"file:{tmp_path}") == ["pointer"]
    assert child_names(spark, f"file:{tmp_path}/nowhere") == []
