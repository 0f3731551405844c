"""Checks and load history of landed files, without reading again what was read before.

Everything the standing checks count is counted once for each content of a source file and kept
beside the landings. A report combines the counts of the files that are current, so the work
grows with what was landed since the last report. A file that is landed again takes its old
counts out of the report with its old content; a compaction, which changes no content, leaves
all counts good.

Not everything is a sum over files. Distinct player ids are kept as bitmaps, 4 KB for 32,768
neighbouring ids, that are united at read. Rankings drop copies of rows also across files: dates
that stand in one file have their counts kept, and only dates that several files share are
counted from their rows.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtledger.functions import full_name
from courtledger.operators import monitoring
from courtledger.operators.clean import clean_strings
from courtledger.operators.matches import clean_matches
from courtledger.operators.rankings import clean_rankings
from courtledger.schemas import CSV_SCHEMAS, STAT_SUFFIXES
from courtledger.session import stored
from courtledger.sources.landing import current_manifest, stored_rows

SUMMARIES = "_summaries"
_CONTENT = ["path", "sha256"]
_SCHEMAS = {
    "totals": "measure string, n bigint",
    "tournaments": "tourney_id string",
    "player_ids": "bucket bigint, ids binary",
    "ranking_dates": "ranking_date date, n bigint, dupes bigint",
    # Written last: counts of a run that is not in here do not exist for readers.
    "done": "",
}
_RANKING = ["ranking_date", "player_id", "rank", "points"]


def _open(spark: SparkSession, bronze: str, name: str) -> DataFrame:
    schema = ", ".join(filter(None, ["path string, sha256 string, run string", _SCHEMAS[name]]))
    try:
        return spark.read.schema(schema).parquet(f"{bronze}/{SUMMARIES}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _rows(spark: SparkSession, bronze: str, kind: str, entries: DataFrame) -> DataFrame:
    """Rows of the files of a kind in ``entries``, each with ``origin``: its file, digest and date."""
    place = ["dt", "landing", "path"]
    wanted = entries.filter(F.col("kind") == kind).select(*place, "sha256")
    # As a struct, out of the reach of the cleaning of text columns.
    origin = F.struct("path", "sha256", "dt").alias("origin")
    rows = stored_rows(spark, bronze, kind).join(wanted, place)
    return rows.select(*CSV_SCHEMAS[kind].fieldNames(), origin)


def _any_stat(prefix: str) -> Column:
    """Whether a match has a statistic of one side: the rows that ``drop_empty_stats`` keeps."""
    return F.coalesce(*[F.col(f"{prefix}_{suffix}") for suffix in STAT_SUFFIXES.values()]).isNotNull()


def _per_file(rows: DataFrame, counts: dict[str, Column]) -> DataFrame:
    counted = rows.groupBy("origin").agg(*[n.alias(measure) for measure, n in counts.items()])
    return counted.unpivot("origin", list(counts), "measure", "n")


def _match_totals(cleaned: DataFrame) -> DataFrame:
    counts = {
        **monitoring.match_counts(),
        "winner_count": F.count_if(_any_stat("w")),
        "loser_count": F.count_if(_any_stat("l")),
    }
    return _per_file(cleaned, counts)


def _player_totals(players: DataFrame) -> DataFrame:
    return _per_file(players, {"players": F.count("*"), "nameless": F.count_if(monitoring.nameless())})


def _id_bitmaps(players: DataFrame) -> DataFrame:
    ids = players.filter(F.col("player_id").isNotNull())
    return ids.groupBy("origin", F.bitmap_bucket_number("player_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("player_id")).alias("ids")
    )


def _date_counts(rankings: DataFrame) -> DataFrame:
    """Distinct rows of a date in a file, and how many are beyond the distinct players."""
    pair = F.col("ranking_date").isNotNull() & F.col("player_id").isNotNull()
    return (
        rankings.dropDuplicates()
        .groupBy("origin", "ranking_date", "player_id")
        .agg(F.count("*").alias("rows"))
        .groupBy("origin", "ranking_date")
        .agg(F.sum("rows").alias("n"), (F.sum("rows") - F.count_if(pair)).alias("dupes"))
    )


class LandedCounts:
    """Counts of the files current up to a date. Making one counts the files not counted yet.

    ``new_files`` says how many those were. The landings of the moment it was made are the ones
    it reports on, whatever is landed meanwhile.
    """

    def __init__(self, spark: SparkSession, bronze: str, as_of: date | None = None):
        self.spark = spark
        self.bronze = bronze
        self.current = stored(current_manifest(spark, bronze, as_of), "current")
        self.new_files = self._count_new()

    def _append(self, counted: DataFrame, name: str, run: str) -> None:
        rows = counted.withColumn("run", F.lit(run))
        if "origin" in rows.columns:
            rows = rows.select("origin.path", "origin.sha256", "*").drop("origin")
        rows.hint("rebalance").write.mode("append").parquet(f"{self.bronze}/{SUMMARIES}/{name}")

    def _count_new(self) -> int:
        new = stored(
            self.current.join(_open(self.spark, self.bronze, "done"), _CONTENT, "left_anti"), "uncounted"
        )
        count = new.count()
        if not count:
            return 0
        # A run of its own: one that was cut off, or runs at the same time, is not added to it.
        run = uuid.uuid4().hex
        matches = clean_matches(_rows(self.spark, self.bronze, "matches", new))
        players = clean_strings(_rows(self.spark, self.bronze, "players", new)).withColumn(
            "full_name", full_name(F.col("name_first"), F.col("name_last"))
        )
        rankings = clean_rankings(_rows(self.spark, self.bronze, "rankings", new), "origin")
        self._append(_match_totals(matches).unionByName(_player_totals(players)), "totals", run)
        self._append(matches.select("origin", "tourney_id").distinct(), "tournaments", run)
        self._append(_id_bitmaps(players), "player_ids", run)
        self._append(_date_counts(rankings), "ranking_dates", run)
        self._append(new.select(*_CONTENT), "done", run)
        return count

    def _of_current(self, name: str) -> DataFrame:
        """Counts of the current contents, with the date each was landed."""
        runs = _open(self.spark, self.bronze, "done").groupBy(*_CONTENT).agg(F.max("run").alias("run"))
        chosen = self.current.select(*_CONTENT, "dt").join(runs, _CONTENT)
        return _open(self.spark, self.bronze, name).join(chosen, [*_CONTENT, "run"])

    @cached_property
    def _totals(self) -> DataFrame:
        return self._of_current("totals")

    @cached_property
    def _dates(self) -> DataFrame:
        """Ranking dates, in how many files each stands, and the counts where that is one."""
        return stored(
            self._of_current("ranking_dates")
            .groupBy("ranking_date")
            .agg(
                F.count("*").alias("files"),
                F.sum("n").alias("n"),
                F.sum("dupes").alias("dupes"),
                F.max("dt").alias("dt"),
            ),
            "ranking-dates",
        )

    @cached_property
    def _shared_rankings(self) -> DataFrame:
        """The distinct rows of dates in several files, with the newest landing each came by."""
        shared = self._dates.filter("files > 1").select(F.col("ranking_date").alias("shared_date"))
        same = F.col("ranking_date").eqNullSafe(F.col("shared_date"))
        paths = self._of_current("ranking_dates").join(shared, same, "left_semi").select("path").distinct()
        files = self.current.join(paths, "path", "left_semi")
        rows = clean_rankings(_rows(self.spark, self.bronze, "rankings", files), "origin")
        newest = F.max("origin.dt").alias("dt")
        return stored(
            rows.join(shared, same, "left_semi").groupBy(*_RANKING).agg(newest), "shared-rankings"
        )

    def _sums(self, *measures: tuple[str, str]) -> DataFrame:
        """One row with the sums of the named measures over all current files."""

        def total(measure: str) -> Column:
            return F.coalesce(F.sum(F.when(F.col("measure") == measure, F.col("n"))), F.lit(0))

        return self._totals.agg(*[total(measure).alias(name) for measure, name in measures])

    def _distinct_players(self) -> DataFrame:
        united = self._of_current("player_ids").groupBy("bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
        return united.agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).alias("ids"))

    def quality_summary(self) -> DataFrame:
        """The standing checks, as ``monitoring.quality_summary`` of the tables gives them."""
        kept = self._dates.filter("files = 1").agg(F.coalesce(F.sum("dupes"), F.lit(0)).alias("dupes"))
        dupes = kept.unionByName(monitoring.repeated_pairs(self._shared_rankings))
        players = self._sums(("players", "total"), ("nameless", "missing"))
        parts = [
            monitoring.stat_checks(self._sums(*[(c, c) for c in ("winner_count", "loser_count")])),
            monitoring.match_checks(self._sums(*[(c, c) for c in monitoring.match_counts()])),
            # One row each, so the join pairs one with one.
            monitoring.player_checks(players.join(F.broadcast(self._distinct_players()))),
            monitoring.ranking_checks(dupes.agg(F.sum("dupes").alias("dupes"))),
        ]
        return reduce(DataFrame.unionByName, parts)

    def load_history(self) -> DataFrame:
        """Rows of each table by the landing date they came with, newest first.

        What several files hold, a tournament or a copy of a ranking, counts for the newest.
        """
        tables = {"total": "fact_matches", "players": "dim_players"}
        tables |= dict.fromkeys(("winner_count", "loser_count"), "fact_match_stats")
        table = reduce(
            lambda rest, m: F.when(F.col("measure") == m, tables[m]).otherwise(rest), tables, F.lit(None)
        )
        tournaments = self._of_current("tournaments").groupBy("tourney_id").agg(F.max("dt").alias("dt"))
        one = F.lit(1).cast("bigint").alias("n")
        parts = [
            self._totals.select(table.alias("table_name"), "dt", "n").filter("table_name IS NOT NULL"),
            tournaments.select(F.lit("dim_tournaments").alias("table_name"), "dt", one),
            self._dates.filter("files = 1").select(F.lit("fact_rankings").alias("table_name"), "dt", "n"),
            self._shared_rankings.select(F.lit("fact_rankings").alias("table_name"), "dt", one),
        ]
        return (
            reduce(DataFrame.unionByName, parts)
            .groupBy("table_name", "dt")
            .agg(F.sum("n").alias("rows_loaded"))
            .filter("rows_loaded > 0")
            .orderBy(F.desc("dt"), "table_name")
        )
