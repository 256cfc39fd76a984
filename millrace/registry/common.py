"""Shared pieces of the registered queries: input tables, sizes and stored intermediates."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.session import configure, partitions_for, working_path
from millrace.sources.files import folder_state

Query = Callable[[SparkSession, str], DataFrame]

_stored: dict[tuple, Any] = {}
_sizes: dict[tuple[str, str], int] = {}
_schemas: dict[tuple[str, str], StructType] = {}


class Inputs:
    """The parquet tables of one folder, with the session set up for those a query has named."""

    def __init__(self, spark: SparkSession, folder: str, task_bytes: int | None = None):
        self.spark = spark
        self.folder = folder
        self.task_bytes = task_bytes
        self.app = spark.sparkContext.applicationId
        self.named: dict[str, int] = {}
        configure(spark, 0, task_bytes)

    @property
    def bytes(self) -> int:
        """Size of the tables named so far; other tables of the folder play no part."""
        return sum(self.named.values())

    def __getitem__(self, name: str) -> DataFrame:
        """A table by name. Size and schema are read once per session."""
        path = f"{self.folder}/{name}.parquet"
        if (self.app, path) not in _schemas:
            _schemas[self.app, path] = self.spark.read.parquet(path).schema
            _sizes[self.app, path] = folder_state(self.spark, path)[1]
        if name not in self.named:
            self.named[name] = _sizes[self.app, path]
            configure(self.spark, self.bytes, self.task_bytes)
        return self.spark.read.schema(_schemas[self.app, path]).parquet(path)

    @property
    def width(self) -> int:
        return partitions_for(self.bytes, self.spark.sparkContext.defaultParallelism)

    def stored(self, label: str, build: Callable[[str], Any]) -> Any:
        """Result of ``build(path)``, built once per session and state of the folder.

        What is stored are tables in the shared working folder, never rows on the driver.
        """
        key = (self.app, self.folder, folder_state(self.spark, self.folder), label)
        if key not in _stored:
            _stored[key] = build(working_path(self.spark, label))
        return _stored[key]


def forget_stored() -> None:
    """Make the next run of every query store its intermediates anew."""
    _stored.clear()


def query(body: Callable[[Inputs], DataFrame], task_bytes: int | None = None) -> Query:
    return lambda spark, folder: body(Inputs(spark, folder, task_bytes))


def sql_round(expression: str, digits: int) -> str:
    """Rounding on the decimal value, the SQL twin of functions.round_half_up."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"
