"""Readers for delimited files and folder listings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import setting


# What a null is in CSV text, so that it differs from an empty string.
NULL_MARK = "\\N"
# Text comes back as it was written: with its blanks, empty strings and quotes.
CSV_TEXT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": NULL_MARK,
}


def detect_delimiter(spark: SparkSession, path: str, candidates: str = ";,") -> str:
    """The candidate that is most frequent in the header line; the first one when none occurs."""
    header = spark.read.text(path).first()
    line = header["value"] if header else ""
    return max(candidates, key=line.count)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    delimiter: str | None = None,
    strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Typed CSV with a header line. A strict read stops on the first malformed row.

    Values with line breaks need ``multi_line``; each file is then read by one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", delimiter or detect_delimiter(spark, path))
        .options(**CSV_TEXT)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .csv(path)
    )


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    delimiter: str = ",",
    strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line and every column as text, without type inference.

    ``columns`` picks columns by the name in the header, in any order. A quote inside a quoted
    field is doubled in the files this reads (JSON arrays in a field). A strict read stops on a
    row that has more or fewer values than the header.
    """
    rows = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .options(**CSV_TEXT)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .csv(path)
    )
    return rows.select(*[F.col(f"`{name}`") for name in columns]) if columns else rows


INPUT_ORDER = ["_file", "_start", "_row"]


def with_input_order(df: DataFrame) -> DataFrame:
    """Add three columns that sort the rows of a file read as they stand in the files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )


def read_hospital(spark: SparkSession, folder: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """One external CSV table per schema, read from ``<folder>/<name>.csv``."""
    return {
        name: read_csv(spark, f"{folder}/{name}.csv", schema, delimiter=",")
        for name, schema in schemas.items()
    }


FILE_LISTING = "path string, length bigint, modificationTime timestamp"


def or_empty(
    spark: SparkSession, schema: T.StructType | str, read: Callable[[], DataFrame]
) -> DataFrame:
    """The result of a read, or no rows when its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and change time of every file below a folder; file contents are not read.

    An empty and a missing folder both give no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    columns = ["path", "length", "modificationTime"]
    return or_empty(spark, FILE_LISTING, lambda: reader.load(path).select(*columns))


def folder_sizes(files: DataFrame, key: str) -> DataFrame:
    """Number and bytes of listed files by the value of ``key`` in folders named ``key=value``.

    The value is decoded as Spark writes it; files outside of such folders are grouped under null.
    """
    named = F.regexp_extract(F.col("path"), f"/{key}=([^/]*)/", 1)
    return (
        files.select(F.when(named != "", F.try_url_decode(named)).alias(key), "length")
        .groupBy(key)
        .agg(F.count("*").alias("file_count"), F.sum("length").alias("bytes"))
    )


def folder_state(spark: SparkSession, path: str) -> tuple[int, int, str]:
    """Number of files, bytes and last change below a folder.

    A listing reads no contents, so its tasks are limited by the cores and not by file size.
    """
    cores = str(spark.sparkContext.defaultParallelism)
    with setting(spark, "spark.sql.files.maxPartitionNum", cores):
        row = (
            list_files(spark, path)
            .agg(
                F.count("*"),
                F.coalesce(F.sum("length"), F.lit(0)),
                F.max("modificationTime").cast("string"),
            )
            .first()
        )
    return tuple(row)
