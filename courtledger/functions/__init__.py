from courtledger.functions.dates import birth_date, compact_date, whole_units_between
from courtledger.functions.numbers import megabytes, percent, ratio
from courtledger.functions.text import (
    best_of_label,
    blank_to_null,
    full_name,
    handedness,
    score_residue,
    strip,
)

__all__ = [
    "best_of_label",
    "birth_date",
    "blank_to_null",
    "compact_date",
    "full_name",
    "handedness",
    "megabytes",
    "percent",
    "ratio",
    "score_residue",
    "strip",
    "whole_units_between",
]
