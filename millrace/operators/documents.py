"""Nested feedback documents: JSON arrays to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import parse_json
from millrace.sources.schemas import RUBRIC_JSON

DEFAULT_MAX_POINTS = 5.0


def nested_rubric(
    text: Column | str, max_points: Column | float = DEFAULT_MAX_POINTS, strict: bool = True
) -> Column:
    """JSON array of rubric items as an array of structs, with max_points added to every item.

    Malformed text fails, or is null when not strict; null text is null either way.
    """
    limit = max_points if isinstance(max_points, Column) else F.lit(float(max_points))
    return F.transform(
        parse_json(text, RUBRIC_JSON, strict),
        lambda item: F.struct(
            item["criterion"].alias("criterion"),
            item["points"].alias("points"),
            limit.cast("double").alias("max_points"),
            item["comment"].alias("comment"),
        ),
    )


def feedback_documents(
    raw: DataFrame, max_points: Column | float = DEFAULT_MAX_POINTS, strict: bool = True
) -> DataFrame:
    """Typed feedback documents from text rows whose rubric column holds a JSON array."""
    return raw.select(
        "_id",
        F.col("submission_id").cast("bigint").alias("submission_id"),
        F.col("teacher_id").cast("bigint").alias("teacher_id"),
        "ts",
        nested_rubric("rubric", max_points, strict).alias("rubric"),
        "overall_comment",
    )


def unnest_rubric(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per rubric item; documents without items give none. Comments are not carried."""
    fields = ["criterion", "points", "max_points"]
    # Zipped from single fields, so that the scan reads these and not the whole items.
    items = F.arrays_zip(*[F.col(f"rubric.{name}").alias(name) for name in fields])
    return documents.select(*keep, F.inline(items)).select(
        *keep,
        "criterion",
        F.col("points").cast("double").alias("points"),
        F.col("max_points").cast("double").alias("max_points"),
    )
