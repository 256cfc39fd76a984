"""Numeric column expressions with fixed rounding and null rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round on the decimal value, so that every engine gives the same last digit."""
    return F.round(_column(value).cast("decimal(38,10)"), digits).cast("double")


def rounded_avg(value: Column | str, digits: int) -> Column:
    return round_half_up(F.avg(_column(value).cast("double")), digits)


def rounded_sum(value: Column | str, digits: int) -> Column:
    return round_half_up(F.sum(_column(value).cast("double")), digits)


def rounded_ratio(total: Column | str, count: Column | str, digits: int) -> Column:
    """Rounded average from a sum and a count that were combined from partial groups."""
    return round_half_up(safe_ratio(total, count), digits)


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it is false or null."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def rate(condition: Column, digits: int = 3) -> Column:
    """Rounded share of rows where the condition holds; null conditions count as misses."""
    return round_half_up(F.avg(flag(condition)), digits)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as double, null for a zero denominator."""
    bottom = _column(denominator).cast("double")
    return _column(numerator).cast("double") / F.nullif(bottom, F.lit(0.0))


def positive_part(value: Column | str) -> Column:
    return F.greatest(_column(value), F.lit(0))
