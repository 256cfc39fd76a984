"""Tables of the session catalog over files that other systems own, one database per source.

A table names a format, a folder and, where the files do not say it themselves, a schema. Creating,
dropping and creating it again never touches the files. Tables of all sources can be joined by one
SQL text; every scan keeps the abilities of its format (needed columns only, pushed filters), and
names are matched without regard to case.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.files import CSV_TEXT


@dataclass(frozen=True)
class ExternalTable:
    """Files of one format below one location, as ``source.name`` of the session catalog.

    ``schema`` is a list of columns as in CREATE TABLE. Without one the format must know its own.
    """

    source: str
    name: str
    format: str
    location: str
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def full_name(self) -> str:
        return f"{quoted(self.source)}.{quoted(self.name)}"

    def create(self, spark: SparkSession) -> None:
        """Create the database, if it is missing, and the table; a table that exists is an error."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.source)}")
        columns = f"({self.schema})" if self.schema else ""
        pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in self.options.items())
        options = f"OPTIONS ({pairs})" if pairs else ""
        spark.sql(
            f"CREATE TABLE {self.full_name} {columns} USING {quoted(self.format)} {options} "
            f"LOCATION {literal(self.location)}"
        )

    def drop(self, spark: SparkSession) -> None:
        """Forget the table; its files stay."""
        spark.sql(f"DROP TABLE IF EXISTS {self.full_name}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.full_name)


def quoted(name: str) -> str:
    """A name as an identifier of SQL, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as a string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def csv_table(source: str, name: str, location: str, schema: str, delimiter: str = ",") -> ExternalTable:
    """Delimited files with a header line. Rows that do not fit the schema fail the read."""
    options = {"header": "true", "sep": delimiter, "mode": "FAILFAST", **CSV_TEXT}
    return ExternalTable(source, name, "csv", location, schema, options)


def document_table(source: str, name: str, location: str, schema: str) -> ExternalTable:
    """JSON documents, one per line; only the fields of the schema are read."""
    return ExternalTable(source, name, "json", location, schema, {"mode": "FAILFAST"})


def columnar_table(source: str, name: str, location: str, schema: str | None = None) -> ExternalTable:
    return ExternalTable(source, name, "parquet", location, schema)


def mount(spark: SparkSession, tables: Iterable[ExternalTable]) -> dict[str, str]:
    """Create all tables, in place of those with their names; the full name of each by its name."""
    tables = list(tables)
    names = [table.name.lower() for table in tables]
    if len(set(names)) < len(names):
        raise ValueError(f"tables of one mount need different names: {sorted(names)}")
    for table in tables:
        table.drop(spark)
        table.create(spark)
    return {table.name: table.full_name for table in tables}


def unmount(spark: SparkSession, tables: Iterable[ExternalTable]) -> None:
    """Drop all tables and the databases that are empty then. No file is touched."""
    tables = list(tables)
    for table in tables:
        table.drop(spark)
    for source in {table.source for table in tables}:
        known = {row[0].lower() for row in spark.sql("SHOW DATABASES").collect()}
        if source.lower() in known and spark.sql(f"SHOW TABLES IN {quoted(source)}").isEmpty():
            spark.sql(f"DROP DATABASE {quoted(source)}")


def federated(spark: SparkSession, text: str, tables: Mapping[str, str]) -> DataFrame:
    """One SQL text over tables of several sources; the text names them IDENTIFIER(:name)."""
    return spark.sql(text, args=dict(tables))
