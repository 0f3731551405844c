"""Counts and audits of runs, as they are kept."""

import uuid
from datetime import date, datetime

import pytest

from courtledger import Warehouse
from courtledger.plans.pipeline import run_landing, run_transform
from courtledger.plans.report_log import ReportLog
from tests.test_summaries import root, write_rankings  # noqa: F401

FIRST, SECOND = datetime(2025, 2, 1, 3), datetime(2025, 2, 8, 3)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "tables"))


def test_every_run_leaves_counts_and_audits(spark, warehouse, tmp_path, root):  # noqa: F811
    bronze = str(tmp_path / "bronze")
    write_rankings(root, "90s", (19950102, 0, 5, 9), (19950102, 1, "Agassi", 9), (19950102, "first", 6, 9))
    log = ReportLog(spark, warehouse.path)
    assert log.counts().collect() == []
    run_landing(spark, str(root), bronze, FIRST.date())
    reports = run_transform(bronze, warehouse, loaded_at=FIRST)
    counts = {(r.load, r.stage): r.n for r in log.counts().collect()}
    assert counts["match_stats", "unpivoted"] == 10
    # 2023: a winner's, none, both; 2024: both, a loser's.
    assert counts["match_stats", "fact_match_stats"] == 6
    assert counts["match_stats", "empty stats dropped"] == 4
    assert counts["rankings", "read"] == 15
    assert counts["rankings", "rejected"] == 1
    # A copy in the 10s, a row that two files share, and one without a date that three share.
    assert counts["rankings", "copies dropped"] == 4
    assert counts["rankings", "malformed"] == 1
    assert counts["rankings", "fact_rankings"] == 10
    assert counts["rankings", "audit: invalid_ranks"] == 1
    for load, report in reports.items():
        assert {s: n for (part, s), n in counts.items() if part == load and s in report.rows} == report.rows
        for name, audit in report.audits.items():
            kept = log.audit(load, name).drop("run")
            assert sorted(map(repr, kept.collect())) == sorted(map(repr, audit.select(*kept.columns).collect()))
            assert counts[load, f"audit: {name}"] == kept.count()

    write_rankings(root, "90s", (19950102, 1, 5, 9))
    run_landing(spark, str(root), bronze, SECOND.date())
    run_transform(bronze, warehouse, loaded_at=SECOND)
    runs = log.counts().filter("load = 'rankings' AND stage = 'rejected'").orderBy("loaded_at").collect()
    assert [(r.loaded_at, r.n) for r in runs] == [(FIRST, 1), (SECOND, 0)]
    assert [r.run for r in log.audit("rankings", "rejected").collect()] == [runs[0].run]


def test_a_run_that_failed_shows_no_audits(spark, warehouse, tmp_path, root, monkeypatch):  # noqa: F811
    bronze = str(tmp_path / "bronze")
    write_rankings(root, "90s", (19950102, 0, 5, 9))
    run_landing(spark, str(root), bronze, date(2025, 2, 1))
    reports = run_transform(bronze, warehouse, loaded_at=FIRST)
    log = ReportLog(spark, warehouse.path)
    monkeypatch.setattr(type(log.counts()), "coalesce", lambda self, n: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        log.record("cut off", SECOND, reports)
    monkeypatch.undo()
    assert log.audit("rankings", "invalid_ranks").count() == 1
