"""Session settings, shuffle width and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every query of this package relies on. Skewed shuffle joins are split by
# adaptive execution; forceOptimizeSkewedJoin keeps the split even where it costs one more
# exchange, which is the case for a join and a grouping on the same key.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join side that fits in memory per partition is hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Bucket files are written sorted, one file per bucket: joins need not sort them again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Joins of tables whose statistics are collected are ordered by them.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    # Files are compressed; the broadcast threshold must be compared with the size in memory.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

# Settings that only a new session can take. Recording the Python call site of every column
# expression costs more than planning the query.
STARTUP_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

BYTES_PER_SHUFFLE_PARTITION = 128 * 1024 * 1024

MIN_SPLIT_BYTES = 128 * 1024 * 1024
MAX_SPLIT_BYTES = 1024 * 1024 * 1024
SCAN_TASKS_PER_CORE = 16

# Bytes per task for queries whose rows unpack to many times their files: numbers in columns, of
# which 16 MB hold more than a million rows that are then sorted, hashed or written as text.
DENSE_TASK_BYTES = 16 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_local_roots: dict[str, str] = {}
_advisory_before: dict[str, str] = {}


def build_session(
    app_name: str = "millrace", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_SETTINGS, **RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def partitions_for(input_bytes: int, cores: int) -> int:
    """Initial shuffle width for an input: one partition per 128 MB, never fewer than the cores."""
    return max(cores, math.ceil(input_bytes / BYTES_PER_SHUFFLE_PARTITION))


def split_bytes_for(input_bytes: int, cores: int, largest: int = MAX_SPLIT_BYTES) -> int:
    """Bytes per scan task: 128 MB, and up to ``largest`` where a core would get too many tasks."""
    wanted = math.ceil(input_bytes / (cores * SCAN_TASKS_PER_CORE))
    return min(largest, max(MIN_SPLIT_BYTES, wanted))


def configure(
    spark: SparkSession, input_bytes: int | None = None, task_bytes: int | None = None
) -> SparkSession:
    """Apply the runtime settings and, for a known input size, scan and shuffle widths.

    Adaptive execution merges small shuffle partitions afterwards, so that width is an upper
    bound. ``task_bytes`` bounds the file bytes of a scan task and of a shuffle partition, also of a
    merged one, until the next call.
    """
    settings = dict(RUNTIME_SETTINGS)
    app_id = spark.sparkContext.applicationId
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        width = partitions_for(input_bytes, cores)
        split = split_bytes_for(input_bytes, cores)
        if task_bytes is not None:
            width = max(width, math.ceil(input_bytes / task_bytes))
            split = min(split, task_bytes)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(width)
        settings["spark.sql.files.maxPartitionBytes"] = str(split)
    if task_bytes is not None:
        _advisory_before.setdefault(app_id, spark.conf.get(ADVISORY))
        settings[ADVISORY] = f"{task_bytes}b"
    elif app_id in _advisory_before:
        settings[ADVISORY] = _advisory_before.pop(app_id)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """One session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def working_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, seen by the driver and every executor.

    It is the folder the cluster names in ``spark.checkpoint.dir``. Only a local master, whose
    executors are the driver process, gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = context.applicationId
    if app_id not in _local_roots:
        _local_roots[app_id] = tempfile.mkdtemp(prefix="millrace-")
    return _local_roots[app_id]


def working_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the working folder."""
    return f"{working_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"
