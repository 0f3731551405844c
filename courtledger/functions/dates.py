"""Date and timestamp expressions. Text that is no date becomes NULL, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_date(text: Column, strict: bool = False) -> Column:
    """``yyyyMMdd`` text as a date; ``strict`` fails on other text instead (in ANSI mode)."""
    return F.to_date(text, "yyyyMMdd") if strict else F.try_to_date(text, "yyyyMMdd")


def birth_date(text: Column) -> Column:
    """Like ``compact_date``, for text that may carry a decimal tail (``19870522.0``)."""
    return compact_date(F.regexp_replace(text, r"\..*$", ""))


def whole_units_between(unit: str, start: Column, end: Column) -> Column:
    """Complete units from start to end: 24 h 59 min are 24 hours."""
    return F.timestamp_diff(unit, start, end)
