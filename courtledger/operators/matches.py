"""Match facts, the tournament dimension derived from them, and match look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.functions import best_of_label, compact_date
from courtledger.operators.clean import clean_strings

# The four attributes that should be the same in every match of a tournament.
TOURNAMENT_ATTRIBUTES = ["tourney_name", "surface", "tourney_level", "draw_size"]


def clean_matches(raw: DataFrame) -> DataFrame:
    """Cleaned text and parsed dates, all file columns kept. Input of everything below."""
    return clean_strings(raw).withColumn("tourney_date", compact_date(F.col("tourney_date")))


def _side(who: str) -> list:
    return [
        f"{who}_seed",
        f"{who}_entry",
        f"{who}_rank",
        f"{who}_rank_points",
        F.col(f"{who}_age").try_cast("int").alias(f"{who}_age"),
        f"{who}_ht",
        f"{who}_hand",
        f"{who}_ioc",
    ]


def project_matches(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "tourney_id",
        "match_num",
        "tourney_date",
        "winner_id",
        "loser_id",
        "surface",
        "draw_size",
        "tourney_level",
        F.upper("round").alias("match_round"),
        best_of_label(F.col("best_of")).alias("best_of"),
        "score",
        F.col("minutes").alias("match_minutes"),
        *_side("winner"),
        *_side("loser"),
    )


def transform_matches(raw: DataFrame) -> DataFrame:
    return project_matches(clean_matches(raw))


def attribute_combinations(cleaned: DataFrame) -> DataFrame:
    """How often each combination of attributes occurs per tournament, and when.

    Map-side combined, and spread by all five columns: a tournament with a large
    share of the matches leaves this step with one row per combination.
    """
    return cleaned.groupBy("tourney_id", *TOURNAMENT_ATTRIBUTES).agg(
        F.count("*").alias("match_count"),
        F.min("tourney_date").alias("first_seen_date"),
        F.max("tourney_date").alias("last_seen_date"),
    )


def derive_tournaments(cleaned: DataFrame) -> DataFrame:
    """One row per tournament: its most frequent combination and its whole date range.

    The smallest ``(-count, attributes)`` is the most frequent combination, ties
    going to the first by attribute with NULL last. As a minimum it is combined
    map-side, which a row-number window would not be.
    """
    preference = [(-F.col("match_count")).alias("rarity")]
    for name in TOURNAMENT_ATTRIBUTES:
        preference += [F.col(name).isNull().alias(f"{name}_missing"), F.col(name)]
    return (
        attribute_combinations(cleaned)
        .groupBy("tourney_id")
        .agg(
            F.min(F.struct(*preference)).alias("modal"),
            F.min("first_seen_date").alias("first_seen_date"),
            F.max("last_seen_date").alias("last_seen_date"),
        )
        .select(
            "tourney_id",
            "modal.tourney_name",
            "modal.tourney_level",
            F.col("modal.surface").alias("typical_surface"),
            F.col("modal.draw_size").alias("typical_draw_size"),
            "first_seen_date",
            "last_seen_date",
        )
    )


def find_matches(
    matches: DataFrame,
    winner_id: int | None = None,
    loser_id: int | None = None,
    tourney_name: str | None = None,
    round_code: str | None = None,
) -> DataFrame:
    """Matches that meet all the given conditions, such as two players in one tournament."""
    wanted = {
        "winner_id": winner_id,
        "loser_id": loser_id,
        "tourney_name": tourney_name,
        "round": round_code,
    }
    for name, value in wanted.items():
        if value is not None:
            matches = matches.filter(F.col(name) == value)
    return matches


def find_players(
    players: DataFrame,
    name_first: str | None = None,
    name_last: str | None = None,
    hand: str | None = None,
) -> DataFrame:
    for name, value in {"name_first": name_first, "name_last": name_last, "hand": hand}.items():
        if value is not None:
            players = players.filter(F.col(name) == value)
    return players


def player_matches(matches: DataFrame, players: DataFrame, tournaments: DataFrame) -> DataFrame:
    """The match report: facts with the names of both players and of the tournament.

    Join sides are left to the optimizer, which broadcasts a dimension only while its
    measured size allows and splits skewed partitions of the fact side otherwise.
    """
    who = players.select("player_id", "full_name", "country_code")
    winners = who.toDF("winner_id", "winner_name", "winner_country")
    losers = who.toDF("loser_id", "loser_name", "loser_country")
    return (
        matches.join(winners, "winner_id", "left")
        .join(losers, "loser_id", "left")
        .join(tournaments.select("tourney_id", "tourney_name"), "tourney_id", "left")
        .select(
            "tourney_date",
            "tourney_id",
            "tourney_name",
            "surface",
            "match_round",
            "winner_id",
            "winner_name",
            "winner_country",
            "winner_rank",
            "loser_id",
            "loser_name",
            "loser_country",
            "loser_rank",
            "score",
            "match_minutes",
            "best_of",
        )
    )
