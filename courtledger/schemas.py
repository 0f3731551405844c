"""Declared input schemas, output tables and their physical layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def struct(columns: str) -> T.StructType:
    """``"a int, b string"`` as a StructType, without needing a session."""
    fields = []
    for column in columns.split(","):
        name, kind = column.split()
        fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


# ---- raw CSV files -----------------------------------------------------------
# File columns bind by position, so their order is part of the format.

PLAYERS_CSV = struct(
    "player_id int, name_first string, name_last string, hand string, "
    "dob string, ioc string, height int, wikidata_id string"
)

RANKINGS_CSV = struct("ranking_date string, rank int, player string, points int")

_SIDE = "{0}_id int, {0}_seed int, {0}_entry string, {0}_name string, {0}_hand string, {0}_ht int, {0}_ioc string, {0}_age float"
_SERVE = "{0}_ace int, {0}_df int, {0}_svpt int, {0}_1stIn int, {0}_1stWon int, {0}_2ndWon int, {0}_SvGms int, {0}_bpSaved int, {0}_bpFaced int"

MATCHES_CSV = struct(
    ", ".join(
        [
            "tourney_id string, tourney_name string, surface string, draw_size int, "
            "tourney_level string, tourney_date string, match_num int",
            _SIDE.format("winner"),
            _SIDE.format("loser"),
            "score string, best_of int, round string, minutes int",
            _SERVE.format("w"),
            _SERVE.format("l"),
            "winner_rank int, winner_rank_points int, loser_rank int, loser_rank_points int",
        ]
    )
)

CSV_SCHEMAS = {"players": PLAYERS_CSV, "matches": MATCHES_CSV, "rankings": RANKINGS_CSV}

# Serve statistic in the table -> suffix of the wide file column.
STAT_SUFFIXES = {
    "aces": "ace",
    "double_faults": "df",
    "service_points": "svpt",
    "first_serves_in": "1stIn",
    "first_serves_won": "1stWon",
    "second_serves_won": "2ndWon",
    "service_games": "SvGms",
    "break_points_saved": "bpSaved",
    "break_points_faced": "bpFaced",
}
STATS = list(STAT_SUFFIXES)

# File names that are landed, and the labels rows get from them.
FILE_PATTERNS = {
    "players": r"atp_players\.csv",
    "rankings": r"atp_rankings_([0-9][0-9]s|current)\.csv",
    "matches": r"atp_matches_[0-9]{4}\.csv",
}
SOURCE_LABELS = {
    "players": "atp_players.csv",
    "rankings": "atp_rankings_*.csv",
    "matches": "atp_matches_*.csv",
}

# ---- output tables -----------------------------------------------------------

AUDIT_COLUMNS = struct("source_file string, loaded_at timestamp, updated_at timestamp")

_MATCH_SIDE = "{0}_seed int, {0}_entry string, {0}_rank int, {0}_rank_points int, {0}_age int, {0}_ht int, {0}_hand string, {0}_ioc string"


@dataclass(frozen=True)
class TableSpec:
    """One warehouse table.

    ``year_of`` names the date column whose year is the storage partition (a
    partition per day would leave many tiny files). ``cluster`` orders rows inside
    the partition and ends in the table key, so that even a cluster value holding
    a large share of the rows can be cut into several files. ``curve`` has what rows
    are looked up by, as it varies within a year; where given, places on a curve over
    it come before the cluster columns. The first gets the highest bit: players, whose
    lookups go through all years. ``looked_up``: columns whose smallest and
    largest value in each file are kept, and that get Bloom filters.
    """

    name: str
    columns: T.StructType
    required: list[str]
    cluster: list[str]
    min_rows: int
    year_of: str | None = None
    unfilled: list[str] = field(default_factory=list)
    curve: list[str] = field(default_factory=list)
    looked_up: list[str] = field(default_factory=list)

    @property
    def year_column(self) -> str | None:
        return self.year_of.replace("_date", "_year") if self.year_of else None

    @property
    def stored(self) -> T.StructType:
        """Every stored column, the partition column last."""
        fields = self.columns.fields + AUDIT_COLUMNS.fields
        if self.year_column:
            fields = fields + [T.StructField(self.year_column, T.IntegerType())]
        return T.StructType(fields)


# Keys, required columns and minimum row counts of the five tables.
TABLES = {
    spec.name: spec
    for spec in [
        TableSpec(
            name="dim_players",
            columns=struct(
                "player_id int, name_first string, name_last string, full_name string, "
                "hand string, dob date, country_code string, height_cm int"
            ),
            required=["player_id"],
            cluster=["player_id"],
            min_rows=1000,
            looked_up=["player_id"],
        ),
        TableSpec(
            name="dim_tournaments",
            columns=struct(
                "tourney_id string, tourney_name string, tourney_level string, "
                "typical_surface string, typical_draw_size int, location string, "
                "country string, first_seen_date date, last_seen_date date"
            ),
            required=["tourney_id", "tourney_name"],
            cluster=["tourney_id"],
            min_rows=10,
            unfilled=["location", "country"],
            looked_up=["tourney_id"],
        ),
        TableSpec(
            name="fact_matches",
            columns=struct(
                "tourney_id string, match_num int, tourney_date date, winner_id int, loser_id int, "
                "surface string, draw_size int, tourney_level string, match_round string, "
                "best_of string, score string, match_minutes int, "
                + _MATCH_SIDE.format("winner")
                + ", "
                + _MATCH_SIDE.format("loser")
            ),
            required=["tourney_id", "match_num", "tourney_date", "winner_id", "loser_id"],
            cluster=["winner_id", "loser_id", "tourney_id", "match_num"],
            min_rows=100,
            year_of="tourney_date",
            curve=["winner_id", "dayofyear(tourney_date)", "substring(tourney_id, 6)"],
            looked_up=["tourney_date", "winner_id", "loser_id", "tourney_id"],
        ),
        TableSpec(
            name="fact_match_stats",
            columns=struct(
                "tourney_id string, match_num int, tourney_date date, player_id int, "
                "player_role string, " + ", ".join(f"{stat} int" for stat in STATS)
            ),
            required=["tourney_id", "match_num", "tourney_date", "player_id", "player_role"],
            cluster=["player_id", "tourney_id", "match_num", "player_role"],
            min_rows=100,
            year_of="tourney_date",
            curve=["player_id", "dayofyear(tourney_date)", "substring(tourney_id, 6)"],
            looked_up=["tourney_date", "player_id", "tourney_id"],
        ),
        TableSpec(
            name="fact_rankings",
            columns=struct(
                "ranking_date date, player_id int, rank int, points int, ranking_sequence int"
            ),
            required=["ranking_date", "player_id", "rank", "points"],
            cluster=["ranking_date", "player_id", "ranking_sequence"],
            min_rows=1000,
            year_of="ranking_date",
            curve=["player_id", "dayofyear(ranking_date)"],
            looked_up=["ranking_date", "player_id"],
        ),
    ]
}
