"""Command line: ``python -m courtledger <command> --database DB --warehouse PATH ...``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame

from courtledger.operators import monitoring
from courtledger.plans.pipeline import (
    Loader,
    run_all,
    run_landing,
    run_preflight,
    run_transform,
    run_validation,
)
from courtledger.session import build_session, stored
from courtledger.plans.report_log import ReportLog
from courtledger.sources.summaries import LandedCounts
from courtledger.streaming.changes import on_change
from courtledger.warehouse import Warehouse

# Command -> kind of input file.
LOADS = {
    "load-players": "players",
    "load-matches": "matches",
    "load-match-stats": "matches",
    "load-rankings": "rankings",
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="courtledger")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, **arguments: str | None) -> None:
        sub = commands.add_parser(name, help=about)
        sub.add_argument("--database", default="courtledger")
        sub.add_argument("--warehouse", required=True, help="shared folder of the tables")
        for argument, meaning in arguments.items():
            sub.add_argument(f"--{argument.replace('_', '-')}", required=True, help=meaning)
        if "source" in arguments or "bronze" in arguments:
            sub.add_argument("--dt", help="date partition, YYYY-MM-DD")
        if name in (*LOADS, "transform"):
            sub.add_argument("--quarantine", action="store_true", help="keep malformed rows out of the tables")

    for name in LOADS:
        command(name, "load one kind of file", input_path="file, folder or glob")
    command("land", "land new and changed files", source="folder of source files", bronze="bronze folder")
    command("transform", "rebuild the tables from what was landed", bronze="bronze folder")
    command("run", "land, transform and validate", source="folder of source files", bronze="bronze folder")
    command(
        "watch",
        "transform and validate once for all landings not handled yet",
        bronze="bronze folder",
        progress="folder that remembers what was handled",
    )
    for name in ("quality", "history"):
        command(f"landed-{name}", f"{name} of what was landed, counting new files only", bronze="bronze folder")
    for name in ("create", "preflight", "validate", "status", "health", "quality", "history", "log"):
        command(name, f"{name} of the tables")
    return top


def show(frame: DataFrame, most: int) -> None:
    """The first rows of a report, and how many there are where that is not all."""
    rows = stored(frame, "report")
    rows.show(most, truncate=False)
    total = rows.count()
    if total > most:
        print(f"the first {most} of {total} rows")


def print_reports(reports: dict) -> None:
    for load, report in reports.items():
        print(f"{load}: {report.rows | report.steps}")
        for name, frame in report.audits.items():
            print(f"{load} / {name}")
            show(frame, 20)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"courtledger {args.command}")
    warehouse = Warehouse(spark, args.database, args.warehouse)
    now = datetime.now(timezone.utc)

    if args.command in LOADS:
        loader = Loader(warehouse, quarantine=args.quarantine)
        raw = loader.scan_once(LOADS[args.command], args.input_path)
        load = getattr(loader, args.command.replace("-", "_"))
        print_reports({args.command: load(raw)})
    elif args.command == "create":
        warehouse.create()
    elif args.command == "preflight":
        warehouse.attach()
        run_preflight(warehouse).show()
    elif args.command == "land":
        day = date.fromisoformat(args.dt) if args.dt else None
        run_landing(spark, args.source, args.bronze, day).show(truncate=False)
    elif args.command == "transform":
        print_reports(run_transform(args.bronze, warehouse, args.dt, quarantine=args.quarantine))
    elif args.command == "run":
        day = date.fromisoformat(args.dt) if args.dt else None
        print_reports(run_all(spark, args.source, args.bronze, warehouse, day) or {})
    elif args.command in ("landed-quality", "landed-history"):
        counts = LandedCounts(spark, args.bronze, date.fromisoformat(args.dt) if args.dt else None)
        show(counts.quality_summary() if args.command == "landed-quality" else counts.load_history(), 1000)
    elif args.command == "watch":

        def rebuild(day: date, kinds: list[str]) -> None:
            print(f"changed: {', '.join(kinds)}")
            print_reports(run_transform(args.bronze, warehouse, day.isoformat()))
            run_validation(warehouse)

        on_change(spark, args.bronze, rebuild, f"{args.progress}/changes").awaitTermination()
    else:
        warehouse.attach()
        reports = {
            "validate": lambda: run_validation(warehouse),
            "status": warehouse.status,
            "health": lambda: monitoring.pipeline_health(warehouse.metadata(), now),
            "quality": lambda: monitoring.quality_summary(warehouse.tables()),
            "log": ReportLog(spark, args.warehouse).counts,
            "history": lambda: monitoring.load_history(warehouse.tables()),
        }
        show(reports[args.command](), 1000)
    spark.stop()


if __name__ == "__main__":
    main()
