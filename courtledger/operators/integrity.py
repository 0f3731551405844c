"""Referential checks and NOT NULL checks.

Foreign keys are counted per distinct key before they meet the dimension, so a key
held by a large share of the fact rows takes part in the join as a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.schemas import TABLES


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def match_player_ids(matches: DataFrame) -> DataFrame:
    """Per player id (NULL included) the number of matches won and lost."""
    roles = F.array(
        F.struct(F.col("winner_id").alias("player_id"), F.lit(1).alias("won"), F.lit(0).alias("lost")),
        F.struct(F.col("loser_id").alias("player_id"), F.lit(0).alias("won"), F.lit(1).alias("lost")),
    )
    return (
        matches.select(F.inline(roles))
        .groupBy("player_id")
        .agg(F.sum("won").alias("won"), F.sum("lost").alias("lost"))
    )


def orphan_players(matches: DataFrame, players: DataFrame) -> DataFrame:
    """Matches whose winner or loser is not a known player; a missing id counts as unknown.

    ``null_winners`` and ``null_losers`` tell the missing ids apart.
    """
    known = distinct_keys(players, "player_id").withColumn("known", F.lit(1))
    unknown = F.col("known").isNull()
    missing = F.col("player_id").isNull()

    def total(column: str, condition):
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return (
        match_player_ids(matches)
        .join(known, "player_id", "left")
        .agg(
            total("won", unknown).alias("orphaned_winners"),
            total("lost", unknown).alias("orphaned_losers"),
            total("won", missing).alias("null_winners"),
            total("lost", missing).alias("null_losers"),
            F.coalesce(F.sum("won"), F.lit(0)).alias("total_rows"),
        )
    )


def orphan_match_ids(matches: DataFrame, players: DataFrame) -> DataFrame:
    """Player ids that occur in matches but not among the players."""
    return (
        match_player_ids(matches)
        .select("player_id")
        .filter(F.col("player_id").isNotNull())
        .join(players.select("player_id"), "player_id", "left_anti")
    )


def orphan_ranking_ids(rankings: DataFrame, players: DataFrame) -> DataFrame:
    return (
        distinct_keys(rankings, "player_id")
        .filter(F.col("player_id").isNotNull())
        .join(players.select("player_id"), "player_id", "left_anti")
    )


MATCH_KEY = ["tourney_id", "match_num", "tourney_date"]


def orphan_stats(stats: DataFrame, matches: DataFrame) -> DataFrame:
    """Statistics keys without a match, and their row counts. A NULL in the key never matches."""
    return (
        stats.groupBy(*MATCH_KEY)
        .agg(F.count("*").alias("stat_rows"))
        .join(matches.select(*MATCH_KEY), MATCH_KEY, "left_anti")
    )


def orphan_tournaments(facts: dict[str, DataFrame], tournaments: DataFrame) -> DataFrame:
    """Per fact table: tournament ids referenced, those unknown, and the rows behind them."""
    known = distinct_keys(tournaments, "tourney_id").withColumn("known", F.lit(1))
    unknown = F.col("known").isNull()
    referenced = None
    for name, fact in facts.items():
        part = (
            fact.groupBy("tourney_id")
            .agg(F.count("*").alias("n"))
            .select(F.lit(name).alias("table_name"), "tourney_id", "n")
        )
        referenced = part if referenced is None else referenced.unionByName(part)
    return (
        referenced.join(known, "tourney_id", "left")
        .groupBy("table_name")
        .agg(
            F.count("*").alias("referenced_ids"),
            F.count_if(unknown).alias("orphaned_ids"),
            F.coalesce(F.sum(F.when(unknown, F.col("n"))), F.lit(0)).alias("orphaned_rows"),
            F.sum("n").alias("total_rows"),
        )
    )


def null_fks(matches: DataFrame) -> DataFrame:
    return matches.agg(
        F.count_if(F.col("winner_id").isNull()).alias("null_winners"),
        F.count_if(F.col("loser_id").isNull()).alias("null_losers"),
        F.count("*").alias("total_rows"),
    )


def required_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL counts of every required column: one pass per table.

    File sources make every column nullable, so NOT NULL has to be counted.
    """
    result = None
    for name, df in tables.items():
        required = TABLES[name].required
        counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        rows = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(c).alias("column_name"),
                    F.col(c).alias("null_count"),
                    F.when(F.col(c) > 0, "FAIL").otherwise("PASS").alias("status"),
                )
                for c in required
            ]
        )
        part = counted.select(F.inline(rows))
        result = part if result is None else result.unionByName(part)
    return result
