"""Small written-out cases: NULLs, ties, blanks, bad dates."""

from datetime import date, datetime

import pytest

from courtledger.functions import compact_date, score_residue, whole_units_between
from courtledger.operators import audits, clean, integrity, match_stats, matches, profile, rankings
from courtledger.operators.players import transform_players
from courtledger.schemas import MATCHES_CSV, PLAYERS_CSV, RANKINGS_CSV, STATS
from pyspark.sql import functions as F


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def match(**given):
    return tuple(given.get(name) for name in MATCHES_CSV.fieldNames())


def match_frame(spark, *given):
    return spark.createDataFrame([match(**g) for g in given], MATCHES_CSV)


def test_clean_strings_trims_blanks_only_and_nullifies(spark):
    df = spark.createDataFrame([(1, "  a ", "   "), (2, "\tb\t", "")], "id int, x string, y string")
    assert rows(clean.clean_strings(df), "id") == [(1, "a", None), (2, "\tb\t", None)]
    assert rows(clean.clean_strings(df, all_whitespace=True), "id")[1] == (2, "b", None)
    assert rows(clean.nullify_blanks(clean.trim_strings(df)), "id") == rows(clean.clean_strings(df), "id")


def test_audit_columns_carry_one_load_time(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    at = datetime(2025, 2, 1, 2, 0, 0)
    assert rows(clean.add_audit_columns(df, "f.csv", at), "id")[0] == (1, "f.csv", at, at)
    stamped = clean.add_audit_columns(df, "f.csv")
    assert stamped.select("loaded_at", "updated_at").distinct().count() == 1


def test_dates_that_do_not_parse_are_null(spark):
    df = spark.createDataFrame([("20240229",), ("20230229",), ("n/a",), (None,)], "t string")
    parsed = [r[0] for r in df.select(compact_date(F.col("t"))).collect()]
    assert parsed == [date(2024, 2, 29), None, None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE|parse"):
        df.select(compact_date(F.col("t"), strict=True)).collect()


def test_whole_units_truncate(spark):
    hours = whole_units_between(
        "HOUR", F.lit(datetime(2024, 1, 1)), F.lit(datetime(2024, 1, 2, 0, 59, 59))
    )
    assert spark.range(1).select(hours).first()[0] == 24


def test_transform_players(spark):
    raw = spark.createDataFrame(
        [
            (1, " Ana ", "Lu", "r", "19870522.0", "ESP", 180, "Q1"),
            (2, None, "Solo", "x", "unknown", None, None, None),
            (3, "  ", None, None, "19991301", "FRA", 190, None),
        ],
        PLAYERS_CSV,
    )
    assert rows(transform_players(raw), "player_id") == [
        (1, "Ana", "Lu", "Ana Lu", "R", date(1987, 5, 22), "ESP", 180),
        (2, None, "Solo", "Solo", "U", None, None, None),
        (3, None, None, None, "U", None, "FRA", 190),
    ]


def test_transform_matches_truncates_age_and_labels(spark):
    raw = match_frame(
        spark,
        dict(tourney_id=" T1 ", match_num=1, tourney_date="20240101", winner_age=24.9, best_of=3, round="sf"),
        dict(tourney_id="T1", match_num=2, tourney_date="bad"),
    )
    found = matches.transform_matches(raw).orderBy("match_num").collect()
    assert (found[0].tourney_id, found[0].winner_age, found[0].best_of, found[0].match_round) == ("T1", 24, "BO3", "SF")
    assert (found[1].tourney_date, found[1].best_of, found[1].loser_age) == (None, None, None)
    assert len(found[0]) == 28


def test_tournaments_take_modal_combination_and_whole_range(spark):
    common = dict(tourney_id="T", tourney_name="Open", tourney_level="A", draw_size=32)
    raw = match_frame(
        spark,
        dict(common, surface="Hard", tourney_date="20240105"),
        dict(common, surface="Hard", tourney_date="20240106"),
        dict(common, surface="Clay", tourney_date="20240101"),
        # a tie: the smaller surface wins, and NULL loses
        dict(common, tourney_id="Tie", surface="Grass", tourney_date="20240101"),
        dict(common, tourney_id="Tie", surface="Clay", tourney_date="20240102"),
        dict(common, tourney_id="Tie", surface=None, tourney_date=None),
    )
    assert rows(matches.derive_tournaments(matches.clean_matches(raw)), "tourney_id") == [
        ("T", "Open", "A", "Hard", 32, date(2024, 1, 1), date(2024, 1, 6)),
        ("Tie", "Open", "A", "Clay", 32, date(2024, 1, 1), date(2024, 1, 2)),
    ]


def test_tournament_audit_ignores_null_and_lists_values(spark):
    raw = match_frame(
        spark,
        dict(tourney_id="A", tourney_name="x", surface="Hard", draw_size=32),
        dict(tourney_id="A", tourney_name="x", surface=None, draw_size=32),
        dict(tourney_id="B", tourney_name="x", surface="Hard", draw_size=64),
        dict(tourney_id="B", tourney_name="y", surface="Hard", draw_size=32),
    )
    found = audits.audit_tournaments(matches.clean_matches(raw)).collect()
    assert [(r.tourney_id, r.total_matches, r.name_values, r.draw_size_values, r.distinct_surfaces) for r in found] == [
        ("B", 2, ["x", "y"], [32, 64], 1)
    ]


def test_unpivot_keeps_two_rows_and_totals(spark):
    raw = match_frame(
        spark,
        dict(tourney_id="T", match_num=1, winner_id=1, loser_id=2, w_ace=5, l_ace=7, l_bpFaced=3),
        dict(tourney_id="T", match_num=2, winner_id=2, loser_id=1, w_ace=1),
    )
    tall = match_stats.unpivot_stats(matches.clean_matches(raw))
    assert tall.count() == 4
    assert tall.agg(F.sum("aces")).first()[0] == 13
    kept = match_stats.match_stats(raw)
    assert rows(kept.select("match_num", "player_id", "player_role", "aces", "break_points_faced"), "match_num", "player_role") == [
        (1, 2, "loser", 7, 3),
        (1, 1, "winner", 5, None),
        (2, 2, "winner", 1, None),
    ]


def stat_frame(spark, *given):
    schema = ", ".join(f"{s} int" for s in STATS)
    return spark.createDataFrame([tuple(g.get(s) for s in STATS) for g in given], schema)


def test_stat_ranges_report_only_broken_rules(spark):
    bad = dict(aces=-1, first_serves_in=9, service_points=8, break_points_saved=2)
    assert rows(audits.audit_stat_ranges(stat_frame(spark, bad, bad, {})), "check_name") == [
        ("first_serves_in_gt_service_points", 2),
        ("negative_aces", 2),
    ]
    assert rows(audits.audit_stat_ranges(stat_frame(spark, dict(aces=1)))) == []


def ranking_frame(spark, *given):
    return spark.createDataFrame(list(given), RANKINGS_CSV)


def test_rankings_are_cleaned_before_dedup_and_numbered(spark):
    raw = ranking_frame(
        spark,
        ("20240101", 5, "7", 100),
        ("20240101", 5, " 7 ", 100),
        ("20240101", 5, "7", 300),
        ("20240101", 2, "7", 50),
        ("20240101", 1, "abc", 50),
    )
    assert rows(rankings.transform_rankings(raw), "ranking_sequence") == [
        (date(2024, 1, 1), 7, 2, 50, 1),
        (date(2024, 1, 1), 7, 5, 300, 2),
        (date(2024, 1, 1), 7, 5, 100, 3),
    ]
    assert [r.player for r in rankings.rejected_rankings(raw).collect()] == ["abc"]


def test_ranking_audits(spark):
    deduped = rankings.dedup_rankings(
        ranking_frame(
            spark,
            ("20240101", 1, "1", 10),
            ("20240101", 2, "2", 20),
            ("20240101", 9, "2", 5),
            ("20240108", 1, "1", 30),
            ("20240108", 2, "2", 20),
            ("20240115", 1, "1", 1),
            ("20240115", 0, "3", 1),
        )
    )
    found = {name: rows(df) for name, df in audits.audit_rankings(deduped).items()}
    assert found["duplicates"] == [(date(2024, 1, 1), 2, 2)]
    assert found["gappy_snapshots"] == [(date(2024, 1, 1), 3, 9, 1, 3.0)]
    assert found["point_inversions"] == [(date(2024, 1, 1), 10, 20)]
    assert audits.audit_invalid_ranks(deduped).count() == 1


def test_orphans_count_nulls_apart_and_do_not_fan_out(spark):
    facts = spark.createDataFrame([(1, 2), (1, 9), (None, 9), (8, 2)], "winner_id int, loser_id int")
    players = spark.createDataFrame([(1,), (1,), (2,), (2,)], "player_id int")
    assert rows(integrity.orphan_players(facts, players)) == [(2, 2, 1, 0, 4)]
    assert rows(integrity.orphan_match_ids(facts, players), "player_id") == [(8,), (9,)]
    ranked = spark.createDataFrame([(1,), (5,), (None,)], "player_id int")
    assert rows(integrity.orphan_ranking_ids(ranked, players)) == [(5,)]


def test_orphan_tournaments_and_stats(spark):
    facts = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "tourney_id string")
    dims = spark.createDataFrame([("A",)], "tourney_id string")
    assert rows(integrity.orphan_tournaments({"f": facts}, dims)) == [("f", 3, 2, 2, 4)]
    day = date(2024, 1, 1)
    key = "tourney_id string, match_num int, tourney_date date"
    stats = spark.createDataFrame([("A", 1, day), ("A", 1, day), ("A", 2, day), ("A", 3, None)], key)
    played = spark.createDataFrame([("A", 1, day), ("A", 3, None)], key)
    assert rows(integrity.orphan_stats(stats, played), "match_num") == [("A", 2, day, 1), ("A", 3, None, 1)]


def test_score_residue(spark):
    df = spark.createDataFrame([("6-4 7-6(5)",), ("6-3 RET",), ("W/O",), (None,)], "s string")
    assert [r[0] for r in df.select(score_residue(F.col("s"))).collect()] == [None, "RET", "W/O", None]


def test_lookups(spark):
    raw = match_frame(
        spark,
        dict(tourney_name="Open", winner_id=1, loser_id=2, round="F"),
        dict(tourney_name="Open", winner_id=2, loser_id=1, round="F"),
        dict(tourney_name="Cup", winner_id=1, loser_id=2, round="F"),
    )
    assert matches.find_matches(raw, winner_id=1, loser_id=2, tourney_name="Open").count() == 1
    assert matches.find_matches(raw, round_code="F").count() == 3
    players = spark.createDataFrame([(1, "A", "B", "R"), (2, "A", "C", "L")], "player_id int, name_first string, name_last string, hand string")
    assert matches.find_players(players, name_first="A", hand="L").count() == 1


def test_profile_of_keys_dates_and_duplicates(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (1, date(2024, 1, 1)), (2, date(2024, 1, 31)), (None, None), (None, None)],
        "k int, d date",
    )
    assert rows(profile.key_uniqueness(df, "k")) == [(5, 2, 3, False)]
    assert rows(profile.grain_check(df, ["k", "d"])) == [(5, 2, False)]
    assert rows(profile.date_coverage(df, "d")) == [(date(2024, 1, 1), date(2024, 1, 31), 30, 2, 2.5)]
    # NULL equals NULL among duplicates
    assert profile.duplicate_rows(df, ["k", "d"]).count() == 4
    assert rows(profile.null_profile(df)) == [("d", 2, 40.0), ("k", 2, 40.0)]


def test_value_counts_and_participation(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y")], "winner_name string, loser_name string")
    assert rows(profile.distinct_values(df, "winner_name"), "winner_name") == [("a",), ("b",)]
    assert rows(profile.value_counts(df, ["winner_name"], top=1)) == [("winner_name", "a", 2)]
    assert rows(profile.participation(df, top=2)) == [("a", 2), ("b", 1)]
    assert rows(profile.participation_summary(df)) == [(4, 5)]
    assert rows(profile.describe_categorical(df), "column_name")[1] == ("winner_name", 3, 2, "a", 2)
