"""Casts that never fail on raw input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CLOCK_FORMAT = "M/d/yyyy h:mm:ss a"


def whole_or_zero(c: Column) -> Column:
    """Number text to a long, cut towards zero; anything unreadable gives 0."""
    return F.coalesce(c.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def double_or(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(float(default)))


def utc_timestamp(c: Column) -> Column:
    """ISO text or 12-hour clock text to a timestamp, else null. Needs a UTC session."""
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit(CLOCK_FORMAT)))


def narrow_number(c: Column) -> Column:
    """JSON text of a number: integral values lose their fraction."""
    whole = c.try_cast("bigint")
    return F.when(c == whole.cast("double"), whole.cast("string")).otherwise(c.cast("string"))
