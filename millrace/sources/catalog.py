"""Names for tables of several sources, so that one SQL text can join them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

Reader = Callable[[SparkSession], DataFrame]


class Catalog:
    """Maps ``source.schema.table`` to a reader; a table is read only when it is used."""

    def __init__(self, readers: Mapping[str, Reader]):
        self._readers = dict(readers)

    def names(self) -> list[str]:
        return sorted(self._readers)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return self._readers[name](spark)

    def register(self, spark: SparkSession) -> list[str]:
        """Create one temporary view per table, named after the last part of its name."""
        views: dict[str, str] = {}
        for name in self.names():
            view = name.rsplit(".", 1)[-1]
            if view in views:
                raise ValueError(f"{name} and {views[view]} would share the view {view}")
            views[view] = name
        for view, name in views.items():
            self.table(spark, name).createOrReplaceTempView(view)
        return sorted(views)
