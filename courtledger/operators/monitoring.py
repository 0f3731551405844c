"""Monitoring views and post-load checks, as functions of the tables.

Nothing here reads a clock: the moment of the check is an argument. Each table is
aggregated once for all checks that concern it, down to one row, before any text is made.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtledger.functions import megabytes, ratio, whole_units_between
from courtledger.operators.integrity import orphan_players
from courtledger.schemas import TABLES

# Thresholds of the checks.
VIEW_BALANCE_WARN = 0.9
POSTLOAD_BALANCE_FAIL = 0.95
POSTLOAD_BALANCED = 0.999
MISSING_SHARE_WARN = 0.05
STALE_VIEW_HOURS = 24
STALE_POSTLOAD_HOURS = 2


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _check(table: str | Column, check: str, status: Column, detail: Column) -> Column:
    return F.struct(
        (F.lit(table) if isinstance(table, str) else table).alias("table_name"),
        F.lit(check).alias("check_name"),
        status.alias("status"),
        detail.alias("detail"),
    )


def _as_of(moment: datetime | Column) -> Column:
    return (F.lit(moment) if isinstance(moment, datetime) else moment).cast("timestamp")


def role_balance(stats: DataFrame) -> DataFrame:
    """Winner and loser rows, their ratio, and its verdict by both thresholds in use."""
    return _balance_verdicts(
        stats.agg(
            F.count_if(F.col("player_role") == "winner").alias("winner_count"),
            F.count_if(F.col("player_role") == "loser").alias("loser_count"),
        )
    )


def _balance_verdicts(counted: DataFrame) -> DataFrame:
    one_sided = (F.col("winner_count") == 0) | (F.col("loser_count") == 0)
    return counted.withColumn(
        "ratio",
        ratio(F.least("winner_count", "loser_count"), F.greatest("winner_count", "loser_count")),
    ).withColumns(
        {
            "view_status": F.when(one_sided, "FAIL")
            .when(F.col("ratio") < VIEW_BALANCE_WARN, "WARN")
            .otherwise("PASS"),
            "postload_status": F.when(one_sided, "missing roles")
            .when(F.col("ratio") >= POSTLOAD_BALANCED, "balanced")
            .when(F.col("ratio") < POSTLOAD_BALANCE_FAIL, "imbalance")
            .otherwise("roughly balanced"),
        }
    )


def match_counts() -> dict[str, Column]:
    """Aggregates over cleaned or projected matches that their checks need."""
    return {
        "null_winners": F.count_if(F.col("winner_id").isNull()),
        "null_losers": F.count_if(F.col("loser_id").isNull()),
        "missing": F.count_if(F.col("score").isNull()),
        "total": F.count("*"),
    }


def match_checks(counted: DataFrame) -> DataFrame:
    """The checks of one row of ``match_counts``."""
    fks = _check(
        "fact_matches",
        "null_foreign_keys",
        F.when(F.col("null_winners") + F.col("null_losers") > 0, "FAIL").otherwise("PASS"),
        F.concat(
            F.lit("null winner_id="), _text("null_winners"), F.lit(", null loser_id="), _text("null_losers")
        ),
    )
    scores = _check(
        "fact_matches",
        "missing_scores",
        F.when(ratio(F.col("missing"), F.col("total")) > MISSING_SHARE_WARN, "WARN").otherwise("PASS"),
        F.concat(_text("missing"), F.lit(" of "), _text("total"), F.lit(" matches missing scores")),
    )
    return counted.select(F.inline(F.array(fks, scores)))


def nameless() -> Column:
    return F.col("full_name").isNull() | (F.col("full_name") == "")


def _player_counts(players: DataFrame) -> DataFrame:
    # Counting per id first keeps the distinct count and the plain counts in one pass.
    return (
        players.groupBy("player_id")
        .agg(F.count("*").alias("n"), F.count_if(nameless()).alias("nameless"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count("player_id").alias("ids"),
            F.coalesce(F.sum("nameless"), F.lit(0)).alias("missing"),
        )
    )


def player_checks(counted: DataFrame) -> DataFrame:
    """The checks of one row ``total, ids, missing``: players, distinct ids, players without a name."""
    counted = counted.withColumn("dupes", F.col("total") - F.col("ids"))
    share = ratio(F.col("missing"), F.col("total"))
    ids = _check(
        "dim_players",
        "duplicate_ids",
        F.when(F.col("dupes") > 0, "FAIL").otherwise("PASS"),
        F.concat(F.lit("duplicate_player_ids="), _text("dupes")),
    )
    names = _check(
        "dim_players",
        "missing_names",
        F.when(share > MISSING_SHARE_WARN, "WARN").otherwise("PASS"),
        F.concat(
            _text("missing"),
            F.lit(" of "),
            _text("total"),
            F.lit(" players missing full_name ("),
            _text(F.round(share * 100, 1)),
            F.lit("%)"),
        ),
    )
    return counted.select(F.inline(F.array(ids, names)))


def repeated_pairs(rankings: DataFrame) -> DataFrame:
    """One row ``dupes``: rows beyond the distinct pairs of date and player, rows without either included."""
    whole = F.col("ranking_date").isNotNull() & F.col("player_id").isNotNull()
    return (
        rankings.groupBy("ranking_date", "player_id")
        .agg(F.count("*").alias("n"))
        .agg((F.coalesce(F.sum("n"), F.lit(0)) - F.count_if(whole)).alias("dupes"))
    )


def ranking_checks(counted: DataFrame) -> DataFrame:
    pairs = _check(
        "fact_rankings",
        "duplicate_date_player",
        F.when(F.col("dupes") > 0, "WARN").otherwise("PASS"),
        F.concat(F.lit("duplicate (date, player) pairs="), _text("dupes")),
    )
    return counted.select(F.inline(F.array(pairs)))


def stat_checks(counted: DataFrame) -> DataFrame:
    """The check of one row ``winner_count, loser_count``."""
    balance = _check(
        "fact_match_stats",
        "player_role_balance",
        F.col("view_status"),
        F.concat(F.lit("winner="), _text("winner_count"), F.lit(", loser="), _text("loser_count")),
    )
    return _balance_verdicts(counted).select(F.inline(F.array(balance)))


def quality_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """The six standing checks: ``(table_name, check_name, status, detail)``."""
    return _union(
        [
            stat_checks(role_balance(tables["fact_match_stats"]).select("winner_count", "loser_count")),
            match_checks(tables["fact_matches"].agg(*[n.alias(c) for c, n in match_counts().items()])),
            player_checks(_player_counts(tables["dim_players"])),
            ranking_checks(repeated_pairs(tables["fact_rankings"])),
        ]
    )


def expected_minimums(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(spec.name, spec.min_rows) for spec in TABLES.values()], "table_id string, expected_min int"
    )


def pipeline_health(metadata: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Size, age and row-count verdict of the managed tables.

    ``metadata``: ``table_id, row_count, size_bytes, last_modified_time`` (epoch
    milliseconds), one row per table.
    """
    now = _as_of(as_of)
    minimums = F.broadcast(expected_minimums(metadata.sparkSession))  # one row per managed table
    modified = F.col("last_modified")
    return (
        metadata.filter(F.col("table_id").isin(list(TABLES)))
        .withColumn("last_modified", F.timestamp_millis("last_modified_time"))
        .join(minimums, "table_id", "left")
        .select(
            "table_id",
            "row_count",
            megabytes(F.col("size_bytes")).alias("size_mb"),
            "last_modified",
            whole_units_between("MINUTE", modified, now).alias("minutes_since_update"),
            F.when(whole_units_between("HOUR", modified, now) > STALE_VIEW_HOURS, "STALE")
            .otherwise("FRESH")
            .alias("freshness_status"),
            F.when(F.col("row_count") == 0, "EMPTY")
            .when(F.col("row_count") < F.col("expected_min"), "LOW")
            .otherwise("OK")
            .alias("row_count_status"),
            "expected_min",
        )
    )


def load_history(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and load, newest load first."""
    parts = [
        df.groupBy("loaded_at")
        .agg(F.count("*").alias("rows_loaded"))
        .select(F.lit(name).alias("table_name"), "loaded_at", "rows_loaded")
        for name, df in tables.items()
    ]
    return _union(parts).orderBy(F.desc("loaded_at"), "table_name")


# ---- post-load validation ----------------------------------------------------


def _metadata_checks(metadata: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Minimum rows and freshness of every expected table, present in the metadata or not."""
    modified = F.timestamp_millis("last_modified_time")
    now = _as_of(as_of)
    enough = _check(
        F.col("table_id"),
        "minimum_rows",
        F.when(F.col("row_count") >= F.col("expected_min"), "PASS").otherwise("FAIL"),
        F.coalesce(
            F.concat(_text("row_count"), F.lit(" rows (expected >= "), _text("expected_min"), F.lit(")")),
            F.lit("table not found"),
        ),
    )
    # Exactly two hours is still fresh.
    fresh = modified >= now - F.make_dt_interval(hours=F.lit(STALE_POSTLOAD_HOURS))
    recent = _check(
        F.col("table_id"),
        "freshness",
        F.when(fresh, "PASS").otherwise("FAIL"),
        F.coalesce(
            F.concat(
                F.lit("last modified "),
                _text(whole_units_between("SECOND", modified, now)),
                F.lit(" s ago"),
            ),
            F.lit("not found in metadata"),
        ),
    )
    expected = expected_minimums(metadata.sparkSession)
    return expected.join(metadata, "table_id", "left").select(F.inline(F.array(enough, recent)))


def _key_checks(matches: DataFrame, players: DataFrame) -> DataFrame:
    """NULL and unknown player ids, from one pass over the matches."""

    def check(name: str, what: str, winners: str, losers: str) -> Column:
        return _check(
            "fact_matches",
            name,
            F.when(F.col(winners) + F.col(losers) > 0, "FAIL").otherwise("PASS"),
            F.concat(
                F.lit(f"winner_id {what}="),
                _text(winners),
                F.lit(f", loser_id {what}="),
                _text(losers),
                F.lit(", rows="),
                _text("total_rows"),
            ),
        )

    nulls = check("null_foreign_keys", "nulls", "null_winners", "null_losers")
    unknown = check("orphaned_players", "orphans", "orphaned_winners", "orphaned_losers")
    return orphan_players(matches, players).select(F.inline(F.array(nulls, unknown)))


def _balance_check(stats: DataFrame) -> DataFrame:
    lopsided = F.col("postload_status").isin("missing roles", "imbalance")
    check = _check(
        "fact_match_stats",
        "role_balance",
        F.when(lopsided, "FAIL").otherwise("PASS"),
        F.concat(
            F.col("postload_status"),
            F.lit(": winners="),
            _text("winner_count"),
            F.lit(", losers="),
            _text("loser_count"),
        ),
    )
    return role_balance(stats).select(F.inline(F.array(check)))


def postload_validation(
    tables: dict[str, DataFrame], metadata: DataFrame, as_of: datetime | Column
) -> DataFrame:
    """Five checks: minimum rows, NULL keys, role balance, unknown players, freshness.

    All are evaluated; ``raise_on_failure`` turns a failed one into an error.
    """
    return _union(
        [
            _metadata_checks(metadata, as_of),
            _key_checks(tables["fact_matches"], tables["dim_players"]),
            _balance_check(tables["fact_match_stats"]),
        ]
    )


class ValidationError(RuntimeError):
    """A check failed, or an expected table is missing."""


def raise_on_failure(checks: DataFrame) -> None:
    """Fails with all failed checks in one message. ``checks`` has a row per check."""
    failed = checks.filter(F.col("status") == "FAIL").collect()
    if failed:
        lines = [f"{row.table_name}/{row.check_name}: {row.detail}" for row in failed]
        raise ValidationError(f"{len(failed)} check(s) failed\n - " + "\n - ".join(lines))
