"""The stream over the manifest log: what counts as a change, across batches and restarts."""

from datetime import date, datetime

import pytest

from courtledger.plans.pipeline import run_landing
from courtledger.sources import compact, land
from courtledger.sources.landing import MANIFEST_LOG, MANIFEST_SCHEMA
from courtledger.streaming.changes import _PROVIDER_CONF, on_change, watch_changes
from tests.test_warehouse import DAY, write_sources

LATER = date(2025, 2, 8)


@pytest.fixture
def log(spark, tmp_path):
    """Appends entries ``(path, day, hour, digest)`` and returns the changes of the next batch."""
    bronze = str(tmp_path / "bronze")

    def deliver(*entries, fail=False):
        rows = [
            (path, date(2025, 2, day), datetime(2025, 2, 1, hour), f"l{hour}", digest, 1, "players")
            for path, day, hour, digest in entries
        ]
        found = []

        def keep(changes, batch_id):
            found.extend((r.path, r.dt.day, r.sha256, r.old_sha256, r.status) for r in changes.collect())
            if fail:
                raise RuntimeError("handling failed")

        if rows:
            spark.createDataFrame(rows, MANIFEST_SCHEMA).write.mode("append").parquet(f"{bronze}/{MANIFEST_LOG}")
        query = watch_changes(spark, bronze, keep, str(tmp_path / "progress"))
        if fail:
            with pytest.raises(Exception, match="handling failed"):
                query.awaitTermination(120)
        else:
            assert query.awaitTermination(120)
        return sorted(found, key=repr)

    return deliver


def test_repeats_and_late_entries_are_no_changes(log):
    assert log(("a", 1, 1, "x"), ("b", 3, 1, "y")) == [("a", 1, "x", None, "new"), ("b", 3, "y", None, "new")]
    assert log(("a", 1, 2, "x"), ("b", 2, 2, "z")) == []  # equal; for an earlier date
    # The repeat has moved the landing of "a" to hour 2; of one date, the later landing counts.
    assert log(("a", 1, 1, "w")) == []
    assert log(("a", 1, 3, "w")) == [("a", 1, "w", "x", "changed")]
    assert log() == []


def test_entries_of_one_batch_count_by_their_outcome(log):
    assert log(("a", 2, 2, "x"), ("a", 1, 1, "y"), ("a", 2, 2, "x")) == [("a", 2, "x", None, "new")]
    assert log(("a", 3, 3, "z"), ("a", 4, 4, "x")) == []  # there and back
    assert log(("a", 4, 5, "z"), ("a", 3, 9, "v")) == [("a", 4, "z", "x", "changed")]


def test_a_failed_batch_is_reported_again(log):
    log(("a", 1, 1, "x"))
    change = [("a", 2, "y", "x", "changed")]
    assert log(("a", 2, 2, "y"), fail=True) == change
    assert log() == change
    assert log() == []


def test_entries_without_values(spark, tmp_path, log):
    rows = [(None, None, None, None, None, None, None), ("a", None, None, None, "x", 1, None)]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).write.parquet(f"{tmp_path}/bronze/{MANIFEST_LOG}")
    found = []
    query = watch_changes(
        spark, str(tmp_path / "bronze"), lambda changes, _: found.extend(changes.collect()), str(tmp_path / "p")
    )
    assert query.awaitTermination(120)
    assert sorted((r.path or "", r.sha256, r.status) for r in found) == [("", None, "new"), ("a", "x", "new")]


def test_other_streams_keep_their_state_store(spark, log):
    before = spark.conf.get(_PROVIDER_CONF, None)
    log(("a", 1, 1, "x"))
    assert spark.conf.get(_PROVIDER_CONF, None) == before


def test_compactions_and_covered_landings_rebuild_nothing(spark, tmp_path):
    root, bronze, progress = tmp_path / "source", str(tmp_path / "bronze"), str(tmp_path / "progress")
    handled = []

    def drain():
        handle = lambda day, kinds: handled.append((day, kinds))
        assert on_change(spark, bronze, handle, progress).awaitTermination(120)
        return handled[-1] if handled else None

    drain()
    assert handled == []
    write_sources(root, players=3, matches=3)
    run_landing(spark, str(root), bronze, LATER)
    first = drain()
    assert first[0] == LATER and {"matches", "players"} <= set(first[1])
    compact(spark, bronze, "players")
    drain()
    assert handled == [first]
    write_sources(root, players=3, matches=3, shift=1)
    land(spark, str(root), bronze, DAY)  # an earlier date: the landing of LATER still counts
    drain()
    assert handled == [first]
    run_landing(spark, str(root), bronze, date(2025, 2, 9))
    assert drain()[0] == date(2025, 2, 9) and len(handled) == 2
