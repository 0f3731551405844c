"""Serve statistics, one row per player and match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.operators.matches import clean_matches
from courtledger.schemas import STAT_SUFFIXES, STATS


def _side(role: str, prefix: str):
    return F.struct(
        F.col(f"{role}_id").alias("player_id"),
        F.lit(role).alias("player_role"),
        *[F.col(f"{prefix}_{suffix}").alias(stat) for stat, suffix in STAT_SUFFIXES.items()],
    )


def unpivot_stats(cleaned: DataFrame) -> DataFrame:
    """Winner and loser columns as two rows per match, from one read of the matches."""
    sides = F.array(_side("winner", "w"), _side("loser", "l"))
    return cleaned.select("tourney_id", "match_num", "tourney_date", F.inline(sides))


def drop_empty_stats(stats: DataFrame) -> DataFrame:
    """Rows where at least one statistic was recorded."""
    return stats.dropna(how="all", subset=STATS)


def match_stats(raw: DataFrame) -> DataFrame:
    return drop_empty_stats(unpivot_stats(clean_matches(raw)))
