"""Restart of a stream job from its own logs, and what a reader may trust meanwhile.

A query plans a batch in its offset log, runs it, and notes it in its commit log. A batch that is
planned but not committed when the job ends is run again, with the same rows and the same number,
by the next start. The sinks replace a batch's rows as a whole, so that each row ends up once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.folders import child_names, delete_path
from millrace.streaming.pipeline import FileSinks


@dataclass(frozen=True)
class Progress:
    """Numbers of the last batch that was planned and of the last one that was committed."""

    planned: int | None
    committed: int | None

    @property
    def pending(self) -> int | None:
        """The batch that the next start runs again; None if all planned ones are committed."""
        return None if self.planned == self.committed else self.planned


def _last(spark: SparkSession, path: str) -> int | None:
    numbers = [int(name) for name in child_names(spark, path) if name.isdigit()]
    return max(numbers, default=None)


def progress(spark: SparkSession, checkpoint: str) -> Progress:
    """What the logs below a checkpoint folder say; both None for a query that never ran."""
    return Progress(_last(spark, f"{checkpoint}/offsets"), _last(spark, f"{checkpoint}/commits"))


def repeat_last_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """Let the next start run the last committed batch again, and return its number.

    For a batch whose outputs were damaged or written by faulty rules. Its offsets stay in the
    offset log, so it gets the same rows. The query must not be running.
    """
    state = progress(spark, checkpoint)
    if state.pending is not None or state.committed is None:
        return state.pending
    delete_path(spark, f"{checkpoint}/commits/.{state.committed}.crc")
    delete_path(spark, f"{checkpoint}/commits/{state.committed}")
    return state.committed


class SinkDown(RuntimeError):
    """A sink that was told to fail."""


@dataclass
class FailingSinks:
    """Sinks that fail when one output of one batch is to be written, and work otherwise.

    Outputs that come before it in the batch are written: this is the state that a lost driver
    leaves between two sinks.
    """

    sinks: FileSinks
    batch_id: int
    output: str
    written: list[tuple[int, str]] = field(default_factory=list)

    def write(self, name: str, rows: DataFrame, batch_id: int) -> None:
        if (batch_id, name) == (self.batch_id, self.output):
            raise SinkDown(f"output {name} of batch {batch_id}")
        self.sinks.write(name, rows, batch_id)
        self.written.append((batch_id, name))

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        self.sinks.finish(spark, batch_id)
