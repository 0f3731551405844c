"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Double division, NULL when the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def megabytes(size_bytes: Column) -> Column:
    return F.round(size_bytes / F.lit(1024.0 * 1024.0), 2)
