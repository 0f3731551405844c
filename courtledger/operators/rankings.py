"""Ranking snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.functions import compact_date
from courtledger.operators.clean import clean_strings
from courtledger.operators.numbering import number_rows


def _typed(raw: DataFrame) -> DataFrame:
    return clean_strings(raw).withColumns(
        {
            "ranking_date": compact_date(F.col("ranking_date")),
            "player_id": F.col("player").try_cast("int"),
        }
    )


def _unreadable_player():
    return F.col("player").isNotNull() & F.col("player_id").isNull()


def clean_rankings(raw: DataFrame, *kept: str) -> DataFrame:
    """Typed rows; those whose player is not a number are in ``rejected_rankings``.

    ``kept``: further columns of ``raw`` to carry along.
    """
    return (
        _typed(raw)
        .filter(~_unreadable_player())
        .select("ranking_date", "player_id", "rank", "points", *kept)
    )


def rejected_rankings(raw: DataFrame) -> DataFrame:
    return _typed(raw).filter(_unreadable_player()).select("ranking_date", "rank", "player", "points")


def dedup_rankings(raw: DataFrame) -> DataFrame:
    """Exact copies removed, after trimming. Copies are combined before the shuffle."""
    return clean_rankings(raw).dropDuplicates()


def sequence_rankings(deduped: DataFrame) -> DataFrame:
    """Numbers the entries a player has on one date, best rank first, more points first."""
    return number_rows(
        deduped,
        keys=["ranking_date", "player_id"],
        order=[F.col("rank").asc_nulls_last(), F.col("points").desc_nulls_last()],
        name="ranking_sequence",
    )


def transform_rankings(raw: DataFrame) -> DataFrame:
    return sequence_rankings(dedup_rankings(raw))
