"""Text, date, JSON and cast expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cast_column(value: Column | str, data_type: str | T.DataType, strict: bool = True) -> Column:
    """Cast that fails on bad text, or gives null for it when not strict."""
    column = _column(value)
    return column.cast(data_type) if strict else column.try_cast(data_type)


def file_name(path: Column | str) -> Column:
    """Last segment of a path; empty for a path that ends in a slash."""
    return F.regexp_extract(_column(path), "[^/]+$", 0)


def labelled(prefix: str, value: Column | str, suffix: str = "") -> Column:
    """Constant text around a column, such as a title, an address or an object path."""
    parts = [F.lit(prefix), _column(value).cast("string")]
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat(*parts)


def days_late(submitted: Column | str, due: Column | str) -> Column:
    """Whole days from the due date to the submission date, negative when early."""
    return F.datediff(_column(submitted).cast("date"), _column(due).cast("date"))


def is_late(submitted: Column | str, due: Column | str) -> Column:
    """True when the submission date is after the due date; the same day is on time."""
    return _column(submitted).cast("date") > _column(due).cast("date")


def decode_utf8(value: Column | str) -> Column:
    return _column(value).cast("string")


def parse_json(value: Column | str, schema: T.DataType | str, strict: bool = False) -> Column:
    """JSON parse: malformed text and fields of a wrong type become null.

    A strict parse fails on text that is no JSON of the schema's kind; null stays null.
    """
    text = _column(value)
    parsed = F.from_json(text, schema)
    if not strict:
        return parsed
    message = F.concat(F.lit("malformed JSON: "), F.substr(text, F.lit(1), F.lit(80)))
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def row_json(*columns: Column | str) -> Column:
    """The given columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns))
