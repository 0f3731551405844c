"""Tables, monitoring, the runner, the arrival stream and the command line."""

import uuid
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from courtledger.__main__ import main, parser, show
from courtledger.operators import monitoring
from courtledger.operators.clean import add_audit_columns
from courtledger.plans.pipeline import Loader, run_all, run_landing, run_transform, run_validation
from courtledger.schemas import MATCHES_CSV, PLAYERS_CSV, TABLES
from courtledger.streaming.arrivals import on_landing
from courtledger.warehouse import Warehouse

NOW = datetime(2025, 2, 1, 2, 0, 0)
DAY = date(2025, 2, 1)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "tables"))


def rankings(spark, *given):
    schema = TABLES["fact_rankings"].columns
    return add_audit_columns(spark.createDataFrame(list(given), schema), "f", NOW)


def test_tables_have_the_declared_columns(warehouse):
    assert {r.table_name: r.present for r in warehouse.preflight().collect()} == dict.fromkeys(TABLES, False)
    warehouse.create()
    warehouse.create()
    assert all(r.present for r in warehouse.preflight().collect())
    for name, spec in TABLES.items():
        assert warehouse.table(name).columns == spec.stored.fieldNames()
        assert warehouse.table(name).isEmpty()


def test_write_replaces_all_or_only_given_years(spark, warehouse):
    early, late = (date(2023, 1, 2), 1, 1, 10, 1), (date(2024, 1, 1), 1, 1, 20, 1)
    seen = warehouse.write("fact_rankings", rankings(spark, early, late))
    assert seen.get["n"] == 2
    warehouse.write("fact_rankings", rankings(spark, (date(2024, 1, 1), 2, 1, 30, 1)), replace_all=False)
    assert rows(warehouse.table("fact_rankings").select("ranking_year", "player_id"), "ranking_year") == [(2023, 1), (2024, 2)]
    warehouse.write("fact_rankings", rankings(spark, late))
    assert rows(warehouse.table("fact_rankings").select("ranking_date", "points")) == [(date(2024, 1, 1), 20)]


def test_year_is_a_partition_that_prunes(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, (date(2023, 1, 2), 1, 1, 10, 1), (date(2024, 1, 1), 1, 1, 20, 1)))
    plan = warehouse.table("fact_rankings").filter("ranking_year = 2024")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ranking_year" in plan


def test_rows_without_a_date_are_stored(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, (None, 1, 1, 10, 1)))
    assert warehouse.table("fact_rankings").count() == 1


def test_tables_survive_the_session_catalog(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, (date(2024, 1, 1), 1, 1, 20, 1)))
    other = Warehouse(spark, f"t_{uuid.uuid4().hex}", warehouse.path)
    other.attach()
    assert other.table("fact_rankings").count() == 1 and not other.exists("dim_players")


def test_publish_copies_to_another_format(spark, warehouse, tmp_path):
    warehouse.write("fact_rankings", rankings(spark, (date(2024, 1, 1), 1, 1, 20, 1)))
    warehouse.publish("fact_rankings", "json", path=str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().points == 20


def test_metadata_and_status(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, (date(2023, 1, 2), 1, 1, 10, 1), (date(2024, 1, 1), 1, 1, 20, 1)))
    warehouse.create(["dim_players"])
    spark.range(3).write.option("path", f"{warehouse.path}/extra").saveAsTable(f"{warehouse.database}.extra")
    meta = {r.table_id: r for r in warehouse.metadata().collect()}
    assert meta["fact_rankings"].row_count == 2 and meta["fact_rankings"].size_bytes > 0
    assert meta["dim_players"].row_count == 0
    age = datetime.now(timezone.utc).timestamp() * 1000 - meta["fact_rankings"].last_modified_time
    assert 0 <= age < 600_000
    status = {r.table_name: (r.status, r.row_count) for r in warehouse.status().collect()}
    assert status["fact_rankings"] == ("ok", 2)
    assert status["extra"] == ("unmanaged", 3)
    assert status["fact_matches"] == ("not found", None)


def metadata_frame(spark, *given):
    return spark.createDataFrame(
        list(given), "table_id string, row_count bigint, size_bytes bigint, last_modified_time bigint"
    )


def millis(moment):
    return int(moment.replace(tzinfo=timezone.utc).timestamp() * 1000)


def test_pipeline_health_truncates_hours(spark):
    found = monitoring.pipeline_health(
        metadata_frame(
            spark,
            ("dim_players", 0, 1048576, millis(NOW - timedelta(hours=24, minutes=59))),
            ("fact_matches", 99, 10, millis(NOW - timedelta(hours=25))),
            ("fact_rankings", 1000, 10, millis(NOW)),
            ("other", 5, 10, millis(NOW)),
        ),
        NOW,
    )
    assert rows(found.select("table_id", "size_mb", "minutes_since_update", "freshness_status", "row_count_status"), "table_id") == [
        ("dim_players", 1.0, 1499, "FRESH", "EMPTY"),
        ("fact_matches", 0.0, 1500, "STALE", "LOW"),
        ("fact_rankings", 0.0, 0, "FRESH", "OK"),
    ]


def quality_tables(spark, players, stats, played, ranked):
    return {
        "dim_players": spark.createDataFrame(players, "player_id int, full_name string"),
        "fact_match_stats": spark.createDataFrame(stats, "player_role string"),
        "fact_matches": spark.createDataFrame(played, "winner_id int, loser_id int, score string"),
        "fact_rankings": spark.createDataFrame(ranked, "ranking_date date, player_id int"),
    }


def test_quality_summary(spark):
    tables = quality_tables(
        spark,
        [(1, "A"), (1, None), (None, ""), (4, "B")],
        [("winner",)] * 10 + [("loser",)] * 8,
        [(1, 2, "6-0"), (None, 2, None)],
        [(DAY, 1), (DAY, 1), (DAY, None)],
    )
    assert rows(monitoring.quality_summary(tables), "table_name", "check_name") == [
        ("dim_players", "duplicate_ids", "FAIL", "duplicate_player_ids=2"),
        ("dim_players", "missing_names", "WARN", "2 of 4 players missing full_name (50.0%)"),
        ("fact_match_stats", "player_role_balance", "WARN", "winner=10, loser=8"),
        ("fact_matches", "missing_scores", "WARN", "1 of 2 matches missing scores"),
        ("fact_matches", "null_foreign_keys", "FAIL", "null winner_id=1, null loser_id=0"),
        ("fact_rankings", "duplicate_date_player", "WARN", "duplicate (date, player) pairs=2"),
    ]


def test_quality_summary_of_empty_tables(spark):
    found = {r.check_name: r for r in monitoring.quality_summary(quality_tables(spark, [], [], [], [])).collect()}
    assert found["player_role_balance"].status == "FAIL"
    assert (found["missing_names"].status, found["missing_names"].detail) == ("PASS", None)
    assert found["duplicate_ids"].status == "PASS"


@pytest.mark.parametrize(
    "winners, losers, view, postload",
    [
        (1000, 1000, "PASS", "balanced"),
        (1000, 960, "PASS", "roughly balanced"),
        (1000, 920, "PASS", "imbalance"),
        (1000, 890, "WARN", "imbalance"),
        (5, 0, "FAIL", "missing roles"),
    ],
)
def test_role_balance(spark, winners, losers, view, postload):
    roles = spark.range(winners + losers).select(
        F.when(F.col("id") < winners, "winner").otherwise("loser").alias("player_role")
    )
    found = monitoring.role_balance(roles).first()
    assert (found.winner_count, found.loser_count, found.view_status, found.postload_status) == (winners, losers, view, postload)


def test_postload_validation_collects_all_issues(spark):
    tables = quality_tables(
        spark, [(1, "A"), (2, "B")], [("winner",), ("loser",)], [(1, 2, "x"), (None, 9, "y")], []
    )
    meta = metadata_frame(
        spark,
        ("dim_players", 1000, 1, millis(NOW - timedelta(hours=2))),
        ("fact_matches", 99, 1, millis(NOW - timedelta(hours=2, seconds=1))),
    )
    checks = monitoring.postload_validation(tables, meta, NOW)
    found = {(r.check_name, r.table_name): (r.status, r.detail) for r in checks.collect()}
    assert len(found) == 13
    assert found["minimum_rows", "dim_players"][0] == "PASS"
    assert found["minimum_rows", "fact_matches"] == ("FAIL", "99 rows (expected >= 100)")
    assert found["minimum_rows", "fact_rankings"] == ("FAIL", "table not found")
    assert found["freshness", "dim_players"][0] == "PASS"
    assert found["freshness", "fact_matches"][0] == "FAIL"
    assert found["freshness", "fact_rankings"] == ("FAIL", "not found in metadata")
    assert found["null_foreign_keys", "fact_matches"] == ("FAIL", "winner_id nulls=1, loser_id nulls=0, rows=2")
    assert found["orphaned_players", "fact_matches"] == ("FAIL", "winner_id orphans=1, loser_id orphans=1, rows=2")
    assert found["role_balance", "fact_match_stats"][0] == "PASS"
    with pytest.raises(monitoring.ValidationError, match="10 check"):
        monitoring.raise_on_failure(checks)


def write_sources(root, players=1200, matches=150, weeks=1, shift=0):
    root.mkdir(exist_ok=True)
    lines = [",".join(PLAYERS_CSV.fieldNames())]
    lines += [f"{p},First{p},Last{p},R,19870522.0,ESP,180,Q{p}" for p in range(1, players + 1)]
    (root / "atp_players.csv").write_text("\n".join(lines) + "\n")
    names = MATCHES_CSV.fieldNames()
    lines = [",".join(names)]
    for m in range(matches):
        given = {
            "tourney_id": f"2024-{m % 15:04d}", "tourney_name": f"Open {m % 15}", "surface": "Hard",
            "draw_size": 32, "tourney_level": "A", "tourney_date": "20240101", "match_num": m,
            "winner_id": 1 + m % players, "loser_id": 1 + (m + 1) % players, "score": "6-4 6-4",
            "best_of": 3, "round": "r32", "w_ace": 3, "l_ace": 1, "w_svpt": 50, "l_svpt": 40,
        }
        lines.append(",".join(str(given.get(n, "")) for n in names))
    (root / "atp_matches_2024.csv").write_text("\n".join(lines) + "\n")
    lines = ["ranking_date,rank,player,points"]
    lines += [f"20240{1 + w}01,{p},{p},{5000 - p + shift}" for w in range(weeks) for p in range(1, players + 1)]
    (root / "atp_rankings_current.csv").write_text("\n".join(lines) + "\n")


def test_run_from_files_to_validated_tables(spark, warehouse, tmp_path):
    root, bronze = tmp_path / "source", str(tmp_path / "bronze")
    write_sources(root)
    reports = run_all(spark, str(root), bronze, warehouse, DAY, datetime.now(timezone.utc))
    assert reports["players"].rows == {"read": 1200, "dim_players": 1200}
    assert reports["matches"].rows == {"read": 150, "dim_tournaments": 15, "fact_matches": 150}
    assert reports["match_stats"].rows == {"read": 150, "fact_match_stats": 300}
    assert reports["rankings"].rows == {"read": 1200, "fact_rankings": 1200}
    assert reports["rankings"].audits["duplicates"].isEmpty()
    assert reports["match_stats"].audits["stat_ranges"].isEmpty()
    assert reports["players"].audits["malformed"].isEmpty()
    assert warehouse.table("dim_players").select("loaded_at").distinct().count() == 1

    # nothing changed: nothing runs
    assert run_all(spark, str(root), bronze, warehouse, DAY) is None

    # a table that was lost is no reason to make an empty one
    files, lost = warehouse.snapshots("fact_rankings").files, f"{warehouse.path}/fact_rankings"
    assert files.rename(lost, f"{lost}-kept")
    with pytest.raises(monitoring.ValidationError, match="missing tables: fact_rankings"):
        run_transform(bronze, warehouse)
    assert files.rename(f"{lost}-kept", lost)

    # one changed file: the other files' rows stay in the tables
    (root / "atp_rankings_20s.csv").write_text("ranking_date,rank,player,points\n20230101,1,1,10\n20230101,1,1,10\n")
    reports = run_all(spark, str(root), bronze, warehouse, date(2025, 2, 8))
    assert reports["rankings"].rows == {"read": 1202, "fact_rankings": 1201}
    assert warehouse.table("dim_players").count() == 1200
    assert run_validation(warehouse).filter("status <> 'PASS'").isEmpty()


def test_validation_fails_on_a_small_table(spark, warehouse, tmp_path):
    root, bronze = tmp_path / "source", str(tmp_path / "bronze")
    write_sources(root, players=200)
    run_landing(spark, str(root), bronze, DAY)
    run_transform(bronze, warehouse)
    with pytest.raises(monitoring.ValidationError, match="dim_players/minimum_rows"):
        run_validation(warehouse)


def test_arrivals_are_handled_once(spark, tmp_path):
    root, bronze, progress = tmp_path / "source", str(tmp_path / "bronze"), str(tmp_path / "progress")
    write_sources(root, players=3, matches=3)
    handled = []

    def drain():
        on_landing(spark, bronze, handled.append, progress).awaitTermination(120)

    run_landing(spark, str(root), bronze, DAY)
    drain()
    drain()
    assert handled == [DAY]
    write_sources(root, players=3, matches=3, shift=1)
    run_landing(spark, str(root), bronze, date(2025, 2, 8))
    drain()
    assert handled == [DAY, date(2025, 2, 8)]


def test_single_loads_from_csv(spark, warehouse, tmp_path):
    root = tmp_path / "source"
    write_sources(root, players=20, matches=30)
    loader = Loader(warehouse, NOW)
    raw = loader.scan_once("matches", f"{root}/atp_matches_*.csv")
    assert loader.load_matches(raw).rows["fact_matches"] == 30
    assert loader.load_match_stats(raw).rows["fact_match_stats"] == 60
    first = warehouse.table("fact_matches").first()
    assert (first.source_file, first.loaded_at) == ("atp_matches_*.csv", NOW)


def test_command_line_arguments():
    args = parser().parse_args(["load-players", "--warehouse", "w", "--input-path", "p.csv"])
    assert (args.command, args.input_path) == ("load-players", "p.csv")
    with pytest.raises(SystemExit):
        parser().parse_args(["load-players"])


def test_command_line_runs(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    root, bronze, tables = tmp_path / "source", str(tmp_path / "bronze"), str(tmp_path / "tables")
    write_sources(root)
    common = ["--database", f"t_{uuid.uuid4().hex}", "--warehouse", tables]
    with pytest.raises(monitoring.ValidationError, match="missing tables"):
        main(["preflight", *common])
    main(["create", *common])
    main(["preflight", *common])
    main(["run", *common, "--source", str(root), "--bronze", bronze, "--dt", "2025-02-01"])
    for command in ("validate", "status", "health", "quality", "history"):
        main([command, *common])
    printed = capsys.readouterr().out
    assert "'fact_rankings': 1200" in printed and "player_role_balance" in printed


def test_reports_say_how_many_rows_they_leave_out(spark, capsys):
    show(spark.range(30), 20)
    show(spark.range(3), 20)
    printed = capsys.readouterr().out
    assert printed.count("the first 20 of 30 rows") == 1 and "of 3 rows" not in printed


def test_queries_without_the_optional_modules(monkeypatch):
    import __spark_entry__
    from courtledger.plans.queries import QUERIES

    def lacking(name):
        raise ModuleNotFoundError("No module named 'something'", name="something")

    monkeypatch.setattr(__spark_entry__, "import_module", lacking)
    with pytest.warns(UserWarning, match="left out"):
        assert __spark_entry__.queries().keys() == QUERIES.keys()
