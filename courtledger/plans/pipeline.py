"""The runner: land, transform, write, validate.

The operators are lazy and pure; this module performs the writes, takes row counts
while they happen, and is the only place that looks at the clock.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courtledger.operators import audits, monitoring
from courtledger.operators.clean import add_audit_columns
from courtledger.operators.manifest import resolve_processing_date
from courtledger.operators.match_stats import drop_empty_stats, unpivot_stats
from courtledger.operators.matches import clean_matches, derive_tournaments, project_matches
from courtledger.operators.players import transform_players
from courtledger.operators.rankings import (
    dedup_rankings,
    rejected_rankings,
    sequence_rankings,
)
from courtledger.plans.report_log import ReportLog
from courtledger.schemas import CSV_SCHEMAS, SOURCE_LABELS, TABLES
from courtledger.session import stored
from courtledger.sources import land, read_bronze, scan_csv
from courtledger.sources.csv import CORRUPT
from courtledger.sources.landing import landing_events
from courtledger.sources.quarantine import diagnose, repair
from courtledger.warehouse import Warehouse


def counted(df: DataFrame, stage: str, metrics: list[tuple[str, Observation]]) -> DataFrame:
    """Counts the rows passing this point when the plan runs; no pass of its own.

    Not for use below a range exchange: its sampling would count every row twice.
    """
    seen = Observation(stage)
    metrics.append((stage, seen))
    return df.observe(seen, F.count(F.lit(1)).alias("n"))


@dataclass
class LoadReport:
    """What a load saw: rows read and rows per table written, and the audit frames (lazy).

    ``steps`` counts the rows in between: malformed, made by unpivoting, rejected, dropped.
    """

    rows: dict[str, int] = field(default_factory=dict)
    steps: dict[str, int] = field(default_factory=dict)
    audits: dict[str, DataFrame] = field(default_factory=dict)


class Loader:
    """Loads of the five tables into one warehouse, all stamped with one load time.

    Malformed rows are loaded with NULL where a field was bad. With ``quarantine`` they are
    loaded only if they can be repaired without loss; the rest is the audit ``quarantined``,
    with field and reason.
    """

    def __init__(self, warehouse: Warehouse, loaded_at: datetime | None = None, quarantine: bool = False):
        self.warehouse = warehouse
        self.quarantine = quarantine
        self.spark = warehouse.spark
        self.loaded_at = loaded_at or datetime.now(timezone.utc)

    def _write(self, table: str, df: DataFrame, kind: str, report: LoadReport) -> None:
        final = add_audit_columns(df, SOURCE_LABELS[kind], self.loaded_at)
        report.rows[table] = self.warehouse.write(table, final).get["n"]

    def scan_once(self, kind: str, input_path: str) -> DataFrame:
        """CSV text parsed a single time, into a table several outputs can read."""
        scanned = scan_csv(self.spark, input_path, CSV_SCHEMAS[kind], keep_malformed=True)
        return stored(scanned, f"staged-{kind}")

    def load_players(self, raw: DataFrame) -> LoadReport:
        report, raw = self._accepted(raw, "players")
        self._write("dim_players", transform_players(raw), "players", report)
        return report

    def load_matches(self, raw: DataFrame) -> LoadReport:
        """The tournament dimension first, then the match facts."""
        report, raw = self._accepted(raw, "matches")
        cleaned = clean_matches(raw)
        self._write("dim_tournaments", derive_tournaments(cleaned), "matches", report)
        self._write("fact_matches", project_matches(cleaned), "matches", report)
        report.audits["inconsistent_tournaments"] = audits.audit_tournaments(cleaned)
        return report

    def load_match_stats(self, raw: DataFrame) -> LoadReport:
        report, raw = self._accepted(raw, "matches")
        kept = drop_empty_stats(unpivot_stats(clean_matches(raw)))
        self._write("fact_match_stats", kept, "matches", report)
        # Every match becomes two rows; what was not written had no statistic.
        report.steps["unpivoted"] = 2 * self._kept(report)
        report.steps["empty stats dropped"] = report.steps["unpivoted"] - report.rows["fact_match_stats"]
        report.audits["stat_ranges"] = audits.audit_stat_ranges(self.warehouse.table("fact_match_stats"))
        return report

    def load_rankings(self, raw: DataFrame) -> LoadReport:
        report, raw = self._accepted(raw, "rankings")
        self._write("fact_rankings", sequence_rankings(dedup_rankings(raw)), "rankings", report)
        written = self.warehouse.table("fact_rankings")
        report.audits.update(audits.audit_rankings(written))
        report.audits["invalid_ranks"] = audits.audit_invalid_ranks(written)
        report.audits["rejected"] = rejected_rankings(raw)
        # One pass over a single column; the rest follows from counts there are.
        report.steps["rejected"] = report.audits["rejected"].count()
        report.steps["copies dropped"] = (
            self._kept(report) - report.steps["rejected"] - report.rows["fact_rankings"]
        )
        return report

    def _accepted(self, raw: DataFrame, kind: str) -> tuple[LoadReport, DataFrame]:
        """A report that counts what was read, and the rows to load."""
        report = LoadReport()
        # Inputs of a load are parquet: counting them reads file footers only.
        report.rows["read"] = raw.count()
        if CORRUPT not in raw.columns:
            return report, raw
        schema, bad = CSV_SCHEMAS[kind], F.col(CORRUPT).isNotNull()
        malformed = raw.filter(bad)
        report.audits["malformed"] = malformed
        report.steps["malformed"] = malformed.count()
        if not self.quarantine:
            return report, raw
        fixed, left = repair(malformed, schema)
        report.steps["repaired"] = fixed.count()
        report.steps["quarantined"] = report.steps["malformed"] - report.steps["repaired"]
        where = [c for c in ("path", "dt") if c in raw.columns]
        report.audits["quarantined"] = diagnose(left, schema, where)
        return report, raw.filter(~bad).select(*schema.fieldNames()).unionByName(fixed)

    @staticmethod
    def _kept(report: LoadReport) -> int:
        return report.rows["read"] - report.steps.get("quarantined", 0)


def run_landing(spark: SparkSession, root: str, bronze: str, dt: date | None = None) -> DataFrame:
    """Lands what changed below ``root``; the landing event, empty when nothing did."""
    day = dt or datetime.now(timezone.utc).date()
    return land(spark, root, bronze, day).summary(spark)


def run_transform(
    bronze: str,
    warehouse: Warehouse,
    dt: str | None = None,
    loaded_at: datetime | None = None,
    quarantine: bool = False,
) -> dict[str, LoadReport]:
    """Rebuilds the five tables from the newest landing of every file up to a date.

    A first run makes the tables. Later on a table that is missing is an error, not made anew.
    Counts and audits go into the ``ReportLog`` of the warehouse; ``quarantine``: see ``Loader``.
    """
    spark = warehouse.spark
    now = loaded_at or datetime.now(timezone.utc)
    day = resolve_processing_date(dt, landing_events(spark, bronze), now.date())
    if any(warehouse.exists(name) for name in TABLES):
        run_preflight(warehouse)
    else:
        warehouse.create()
    loader = Loader(warehouse, now, quarantine)
    matches = read_bronze(spark, bronze, "matches", day)

    def matches_then_stats() -> dict[str, LoadReport]:
        return {
            "matches": loader.load_matches(matches),
            "match_stats": loader.load_match_stats(matches),
        }

    # Independent loads share the cluster: while one ends in a few tasks, another fills it.
    with ThreadPoolExecutor(max_workers=3) as pool:
        players = pool.submit(loader.load_players, read_bronze(spark, bronze, "players", day))
        facts = pool.submit(matches_then_stats)
        rankings = pool.submit(loader.load_rankings, read_bronze(spark, bronze, "rankings", day))
        reports = {"players": players.result(), **facts.result(), "rankings": rankings.result()}
    ReportLog(spark, warehouse.path).record(uuid.uuid4().hex, now, reports)
    return reports


def run_preflight(warehouse: Warehouse) -> DataFrame:
    """Presence of the expected tables; raises when one is missing."""
    found = warehouse.preflight()
    missing = [row.table_name for row in found.collect() if not row.present]
    if missing:
        raise monitoring.ValidationError(f"missing tables: {', '.join(missing)}")
    return found


def run_validation(warehouse: Warehouse, as_of: datetime | None = None) -> DataFrame:
    """The post-load checks; raises when one of them fails."""
    checks = monitoring.postload_validation(
        warehouse.tables(), warehouse.metadata(), as_of or datetime.now(timezone.utc)
    )
    monitoring.raise_on_failure(checks)
    return checks


def run_all(
    spark: SparkSession,
    root: str,
    bronze: str,
    warehouse: Warehouse,
    dt: date | None = None,
    now: datetime | None = None,
) -> dict[str, LoadReport] | None:
    """Land, then transform and validate if anything was landed."""
    if run_landing(spark, root, bronze, dt).isEmpty():
        return None
    reports = run_transform(bronze, warehouse, dt.isoformat() if dt else None, now)
    run_validation(warehouse)
    return reports
