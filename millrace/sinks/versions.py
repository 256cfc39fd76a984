"""Collections of tables that change as a whole: written apart, checked, then shown by one switch.

A collection is a folder with one subfolder per version and a small file that names the current
one first. A new version is written and checked beside the current one. Only then the file is replaced,
which every file system that Spark uses does in one step, so that a reader finds the old tables
or the new ones, never a mixture, and a load that fails at any point leaves everything as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.constraints import duplicate_keys
from millrace.sources.folders import delete_path, read_small, write_small

CURRENT = "_current"
VERSIONS = "versions"


class Draft:
    """A version that is not shown yet."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark = spark
        self.version = version
        self.path = f"{root}/{VERSIONS}/{version}"

    def write(self, name: str, rows: DataFrame, sink_format: str = "parquet") -> DataFrame:
        """Store one table of the version; what is returned is read back, and can be checked."""
        options = {"compression": "zstd"} if sink_format == "parquet" else {}
        rows.write.format(sink_format).options(**options).save(f"{self.path}/{name}")
        return self.spark.read.format(sink_format).schema(rows.schema).load(f"{self.path}/{name}")


class Collection:
    """Tables below one folder, by name, in versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def history(self) -> list[str]:
        """The current version and the earlier ones that are kept, newest first."""
        return (read_small(self.spark, f"{self.root}/{CURRENT}") or "").split()

    def current(self) -> str | None:
        """The version that readers get; None before the first one."""
        return next(iter(self.history()), None)

    def table(self, name: str, sink_format: str = "parquet") -> DataFrame:
        """A table of the current version. The frame keeps to it when a newer one is shown."""
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"no version of the collection {self.root} yet")
        return self.spark.read.format(sink_format).load(f"{self.root}/{VERSIONS}/{version}/{name}")

    @contextmanager
    def replacing(self, keep: int = 1) -> Iterator[Draft]:
        """A draft that becomes the current version when the block ends without an error.

        Otherwise its files are deleted. Of the versions before it the last ``keep`` stay, for
        readers that have begun and for ``show``.
        """
        draft = Draft(self.spark, self.root, uuid.uuid4().hex)
        try:
            yield draft
        except BaseException:
            delete_path(self.spark, draft.path)
            raise
        order = [draft.version, *self.history()]
        self._point(order[: keep + 1])
        for version in order[keep + 1 :]:
            delete_path(self.spark, f"{self.root}/{VERSIONS}/{version}")

    def show(self, version: str) -> None:
        """Go back, or forward, to a version that is kept."""
        history = self.history()
        if version not in history:
            raise ValueError(f"the collection {self.root} keeps no version {version}")
        self._point([version, *(v for v in history if v != version)])

    def _point(self, order: list[str]) -> None:
        write_small(self.spark, f"{self.root}/{CURRENT}", "\n".join(order))


class LoadRejected(ValueError):
    """A load whose tables break their rules; nothing of it is shown."""

    def __init__(self, reasons: list[str]):
        super().__init__("; ".join(reasons))
        self.reasons = reasons


Check = Callable[[Mapping[str, DataFrame]], DataFrame]


def replace_all(
    collection: Collection, tables: Mapping[str, DataFrame], checks: Mapping[str, Check], keep: int = 1
) -> str:
    """Replace all tables of a collection at once, or none.

    Every table is stored first, so that a malformed row anywhere fails here, and the checks see
    what will be shown. A check gives the rows that break its rule; all broken rules are reported
    with one such row each. Returns the new version.
    """
    with collection.replacing(keep) as draft:
        stored = {name: draft.write(name, rows) for name, rows in tables.items()}
        reasons = []
        for rule, check in checks.items():
            row = check(stored).first()
            if row is not None:
                reasons.append(f"{rule}: {row.asDict()}")
        if reasons:
            raise LoadRejected(reasons)
    return draft.version


def replace_collection(df: DataFrame, root: str, unique_key: list[str], keep: int = 1) -> str:
    """Replace a collection of one table, ``rows``, whose key must be unique."""
    collection = Collection(df.sparkSession, root)
    unique = {f"unique {', '.join(unique_key)}": lambda tables: duplicate_keys(tables["rows"], unique_key)}
    return replace_all(collection, {"rows": df}, unique, keep)


def read_collection(spark: SparkSession, root: str) -> DataFrame:
    return Collection(spark, root).table("rows")
