"""Typing projections over text tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import cast_column, file_name, labelled

DEFAULT_STORE = "s3://course-data/"


def cast_columns(
    df: DataFrame, types: Mapping[str, str | T.DataType], strict: bool = True
) -> DataFrame:
    """The named columns only, each cast to its type; bad text fails, or is null when not strict."""
    return df.select(
        *[cast_column(name, kind, strict).alias(name) for name, kind in types.items()]
    )


def file_manifest(raw: DataFrame, store: str = DEFAULT_STORE, strict: bool = True) -> DataFrame:
    """Typed file manifest. Sizes in bytes come from the whole-number text, so a size with a
    fraction fails in a strict read."""
    return raw.select(
        cast_column("submission_id", "int", strict).alias("submission_id"),
        cast_column("assignment_id", "int", strict).alias("assignment_id"),
        cast_column("student_id", "int", strict).alias("student_id"),
        file_name("file_path").alias("file_name"),
        cast_column("size_kb", "double", strict).alias("size_kb"),
        (cast_column("size_kb", "bigint", strict) * F.lit(1024)).alias("size_bytes"),
        labelled(store, "file_path").alias("object_path"),
    )


def normalize_fields(
    df: DataFrame,
    fields: Mapping[str, str],
    whole_numbers: tuple[str, ...] = ("quality",),
    strict: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rename known columns and make them numeric; absent ones are skipped, others dropped.

    A whole number is read as a double first and then cut, so "5.9" becomes 5. Columns in
    ``keep`` pass through unchanged, such as the one that holds the input order.
    """
    chosen = [F.col(name) for name in keep]
    for source, target in fields.items():
        if source not in df.columns:
            continue
        number = cast_column(F.col(f"`{source}`"), "double", strict)
        if target in whole_numbers:
            number = number.cast("int") if strict else number.try_cast("int")
        chosen.append(number.alias(target))
    return df.select(*chosen)
