"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Handedness codes that are kept; everything else is unknown.
HANDS = ["R", "L", "A", "U"]
UNKNOWN_HAND = "U"


def strip(text: Column, all_whitespace: bool = False) -> Column:
    """Blanks off both ends; with ``all_whitespace`` also tabs and line ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "") if all_whitespace else F.trim(text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def handedness(code: Column) -> Column:
    upper = F.upper(code)
    return F.when(upper.isin(HANDS), upper).otherwise(F.lit(UNKNOWN_HAND))


def full_name(first: Column, last: Column) -> Column:
    """The present parts joined by a blank; NULL when both are missing."""
    return blank_to_null(F.concat_ws(" ", first, last))


def best_of_label(sets: Column) -> Column:
    return F.concat(F.lit("BO"), sets.cast("string"))


def score_residue(score: Column) -> Column:
    """What is left of a score without digits and punctuation; NULL when nothing is."""
    return blank_to_null(F.regexp_replace(score, r"[0-9\-() ]", ""))
