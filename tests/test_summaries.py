"""Counts kept for each file against counting all rows anew."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from courtledger.operators import monitoring
from courtledger.operators.match_stats import drop_empty_stats, unpivot_stats
from courtledger.operators.matches import clean_matches, project_matches
from courtledger.operators.players import transform_players
from courtledger.operators.rankings import clean_rankings, dedup_rankings, sequence_rankings
from courtledger.schemas import MATCHES_CSV, PLAYERS_CSV
from courtledger.sources import compact, land, read_bronze
from courtledger.sources import summaries
from courtledger.sources.summaries import LandedCounts

DAYS = [date(2025, 2, d) for d in (1, 8, 15)]


def write(root, name, header, lines):
    root.mkdir(exist_ok=True)
    (root / name).write_text("\n".join([",".join(header), *lines]) + "\n")


def write_players(root, *players):
    write(root, "atp_players.csv", PLAYERS_CSV.fieldNames(), [f"{i},{first},,R,,ESP,," for i, first in players])


def write_matches(root, year, *matches):
    """Matches as ``tourney, winner, loser, score, winner's aces, loser's aces``."""
    names = ["tourney_id", "winner_id", "loser_id", "score", "w_ace", "l_ace"]
    lines = []
    for match in matches:
        given = dict(zip(names, match))
        lines.append(",".join(str(given.get(n, "")) for n in MATCHES_CSV.fieldNames()))
    write(root, f"atp_matches_{year}.csv", MATCHES_CSV.fieldNames(), lines)


def write_rankings(root, part, *rankings):
    header = ["ranking_date", "rank", "player", "points"]
    write(root, f"atp_rankings_{part}.csv", header, [",".join(map(str, r)) for r in rankings])


def tables(spark, bronze, day):
    cleaned = clean_matches(read_bronze(spark, bronze, "matches", day))
    return {
        "dim_players": transform_players(read_bronze(spark, bronze, "players", day)),
        "fact_matches": project_matches(cleaned),
        "fact_match_stats": drop_empty_stats(unpivot_stats(cleaned)),
        "fact_rankings": sequence_rankings(dedup_rankings(read_bronze(spark, bronze, "rankings", day))),
    }


def history_anew(spark, bronze, day):
    """The history by plain counting over all current rows."""
    counts = {}

    def count(table, days):
        for dt in days:
            counts[table, dt] = counts.get((table, dt), 0) + 1

    def newest(rows):
        last = {}
        for *key, dt in rows:
            last[tuple(key)] = max(dt, last.get(tuple(key), dt))
        return last.values()

    players = read_bronze(spark, bronze, "players", day).collect()
    matches = clean_matches(read_bronze(spark, bronze, "matches", day)).collect()
    rankings = clean_rankings(read_bronze(spark, bronze, "rankings", day), "dt").collect()
    count("dim_players", [r.dt for r in players])
    count("fact_matches", [r.dt for r in matches])
    count("dim_tournaments", newest((r.tourney_id, r.dt) for r in matches))
    for side in "wl":
        recorded = [r.dt for r in matches if any(v is not None for n, v in r.asDict().items() if n.startswith(f"{side}_"))]
        count("fact_match_stats", recorded)
    count("fact_rankings", newest(rankings))
    return counts


def check(spark, bronze, day, new_files):
    counts = LandedCounts(spark, bronze, day)
    assert counts.new_files == new_files
    expected = monitoring.quality_summary(tables(spark, bronze, day))
    assert sorted(counts.quality_summary().collect()) == sorted(expected.collect())
    history = {(r.table_name, r.dt): r.rows_loaded for r in counts.load_history().collect()}
    assert history == history_anew(spark, bronze, day)
    return {r.check_name: r.detail for r in expected.collect()}


@pytest.fixture
def root(tmp_path):
    """Files with ids of many sizes, empty values, and rankings shared by two files."""
    root = tmp_path / "source"
    ids = [1, 1, 0, -1, -40000, 32768, 32769, 2**31 - 1, -(2**31)]
    write_players(root, *((i, f"N{i}") for i in ids), ("", "No"), ("", ""), (7, ""))
    write_matches(root, 2023, ("a", 1, 2, "6-4", 3, ""), ("b", "", 2, "", "", ""), ("", 1, "", "6-4", 1, 1))
    write_matches(root, 2024, ("a", 2, 1, "6-4", 3, 2), ("c", 2, 1, " ", "", 2))
    write_rankings(root, "10s", (20190107, 1, 1, 90), (20190107, 1, 1, 90), (20190107, 2, 1, 80), ("", 3, 2, 5))
    shared = [(20200106, 1, 1, 90), (20200106, 1, 2, 90), (20200106, 5, "", 1), ("bad", 3, 2, 5)]
    write_rankings(root, "20s", *shared)
    write_rankings(root, "current", shared[0], (20200106, 2, 1, 70), ("", 3, 2, 5), (20200113, 1, 1, 1))
    return root


def test_counts_follow_what_is_landed(spark, tmp_path, root):
    bronze = str(tmp_path / "bronze")
    land(spark, str(root), bronze, DAYS[0])
    details = check(spark, bronze, DAYS[0], new_files=6)
    assert details["duplicate_ids"] == "duplicate_player_ids=3"  # one id twice, two rows without
    assert details["duplicate_date_player"] == "duplicate (date, player) pairs=4"
    check(spark, bronze, DAYS[0], new_files=0)
    # An edited, an emptied, a new and a shared file that shares no more.
    write_players(root, (1, "A"), (2, "B"))
    write_matches(root, 2023)
    write_matches(root, 2025, ("a", 1, 2, "6-4", 3, 2))
    write_rankings(root, "current", (20200113, 1, 1, 1))
    land(spark, str(root), bronze, DAYS[1])
    details = check(spark, bronze, DAYS[1], new_files=4)
    assert details["duplicate_ids"] == "duplicate_player_ids=0"
    # The state of the week before is still there, and needs no counting.
    check(spark, bronze, DAYS[0], new_files=0)
    # Compacted files have landings of their own and the contents they had.
    for kind in ("players", "matches", "rankings"):
        compact(spark, bronze, kind)
    check(spark, bronze, DAYS[1], new_files=0)
    # A content that was current before is known.
    write_rankings(root, "current", (20200106, 1, 1, 90), (20200106, 2, 1, 70), ("", 3, 2, 5), (20200113, 1, 1, 1))
    land(spark, str(root), bronze, DAYS[2])
    check(spark, bronze, DAYS[2], new_files=0)


def test_counts_of_a_run_cut_off_are_not_used(spark, tmp_path, root, monkeypatch):
    bronze = str(tmp_path / "bronze")
    land(spark, str(root), bronze, DAYS[0])
    append = LandedCounts._append

    def die(self, counted, name, run):
        if name == "ranking_dates":
            raise OSError("lost")
        append(self, counted, name, run)

    monkeypatch.setattr(LandedCounts, "_append", die)
    with pytest.raises(OSError, match="lost"):
        LandedCounts(spark, bronze)
    monkeypatch.undo()
    check(spark, bronze, DAYS[0], new_files=6)


def test_two_runs_at_once_count_once(spark, tmp_path, root, monkeypatch):
    bronze = str(tmp_path / "bronze")
    land(spark, str(root), bronze, DAYS[0])
    opened = summaries._open
    LandedCounts(spark, bronze)
    # The second run does not see the first one's end.
    unseen = lambda spark, bronze, name: opened(spark, f"{bronze}/nowhere", name)
    monkeypatch.setattr(summaries, "_open", unseen)
    assert LandedCounts(spark, bronze).new_files == 6
    monkeypatch.undo()
    check(spark, bronze, DAYS[0], new_files=0)


def test_nothing_landed(spark, tmp_path):
    counts = LandedCounts(spark, str(tmp_path / "bronze"))
    assert counts.new_files == 0
    assert counts.load_history().collect() == []
    found = {(r.check_name, r.status) for r in counts.quality_summary().collect()}
    assert ("duplicate_ids", "PASS") in found and ("player_role_balance", "FAIL") in found
    assert len(found) == 6
    assert counts.quality_summary().filter(F.col("detail").isNull()).select("check_name").collect() == [
        r for r in monitoring.quality_summary(tables(spark, str(tmp_path / "bronze"), None))
        .filter(F.col("detail").isNull()).select("check_name").collect()
    ]
