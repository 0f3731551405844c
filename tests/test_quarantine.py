"""Malformed rows: faults found, rows repaired, and loads that keep them out."""

import uuid
from datetime import datetime

from courtledger import Warehouse
from courtledger.plans.pipeline import Loader
from courtledger.schemas import PLAYERS_CSV
from courtledger.sources.csv import CORRUPT, scan_csv
from courtledger.sources.quarantine import diagnose, repair
from pyspark.sql import functions as F

LINES = {
    "fits": "1,A,B,R,19870522,ESP,180,Q1",
    "empty": "2,,,,,,,",
    "decimal": "3,A,B,R,19870522,ESP,180.0,Q3",
    "blanks": " 4 ,A,B,R,19870522,ESP, 181 ,Q4",
    "half": "5,A,B,R,19870522,ESP,180.5,Q5",
    "word": "x6,A,B,R,19870522,ESP,tall,Q6",
    "short": "7,A,B",
    "long": "8,A,B,R,19870522,ESP,180,Q8,more",
    "quoted": '9,"A, or ""B""",B,R,19870522,ESP,180.0,Q9',
    "huge": "99999999999,A,B,R,19870522,ESP,180,Q10",
    "only blanks": "11,A,B,R,19870522,ESP,  ,Q11",
}


def scanned(spark, tmp_path, lines=LINES.values()):
    header = ",".join(PLAYERS_CSV.fieldNames())
    (tmp_path / "atp_players.csv").write_text("\n".join([header, *lines]) + "\n")
    return scan_csv(spark, str(tmp_path / "atp_players.csv"), PLAYERS_CSV, keep_malformed=True).cache()


def test_faults(spark, tmp_path):
    bad = scanned(spark, tmp_path).filter(F.col(CORRUPT).isNotNull())
    names = {line: name for name, line in LINES.items()}
    found = sorted(
        (names[r.malformed_text], r.field or "", r.value, r.reason) for r in diagnose(bad, PLAYERS_CSV).collect()
    )
    assert found == [
        ("blanks", "height", " 181 ", "not int"),
        ("blanks", "player_id", " 4 ", "not int"),
        ("decimal", "height", "180.0", "not int"),
        ("half", "height", "180.5", "not int"),
        ("huge", "player_id", "99999999999", "not int"),
        ("long", "", None, "9 fields of 8"),
        ("only blanks", "height", "  ", "not int"),
        ("quoted", "height", "180.0", "not int"),
        ("short", "", None, "3 fields of 8"),
        ("word", "height", "tall", "not int"),
        ("word", "player_id", "x6", "not int"),
    ]


def test_repair_loses_nothing(spark, tmp_path):
    bad = scanned(spark, tmp_path).filter(F.col(CORRUPT).isNotNull())
    fixed, left = repair(bad, PLAYERS_CSV)
    assert fixed.schema.simpleString() == PLAYERS_CSV.simpleString()
    assert sorted((r.player_id, r.height) for r in fixed.collect()) == [(3, 180), (4, 181), (9, 180), (11, None)]
    kept = sorted(LINES[n] for n in ("half", "word", "short", "long", "huge"))
    assert sorted(r[CORRUPT] for r in left.collect()) == kept
    assert left.columns == bad.columns


def test_nothing_malformed(spark, tmp_path):
    bad = scanned(spark, tmp_path, [LINES["fits"], LINES["empty"]]).filter(F.col(CORRUPT).isNotNull())
    fixed, left = repair(bad, PLAYERS_CSV)
    assert diagnose(bad, PLAYERS_CSV).isEmpty() and fixed.isEmpty() and left.isEmpty()


def test_text_without_a_known_fault_and_clashing_names(spark):
    rows = [(LINES["fits"], "a", 1), (None, "b", 2)]
    bad = spark.createDataFrame(rows, f"{CORRUPT} string, field string, height int").drop("field")
    found = {(r.malformed_text, r.reason) for r in diagnose(bad, PLAYERS_CSV).collect()}
    assert found == {(LINES["fits"], "unreadable"), (None, "unreadable")}
    fixed, left = repair(bad, PLAYERS_CSV)
    assert [r.height for r in fixed.collect()] == [180]
    assert [tuple(r) for r in left.collect()] == [(None, 2)]


def test_loads_with_and_without_quarantine(spark, tmp_path):
    scanned(spark, tmp_path)
    warehouse = Warehouse(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "tables"))
    for quarantine, written in ((False, 11), (True, 6)):
        loader = Loader(warehouse, datetime(2025, 2, 1), quarantine)
        report = loader.load_players(loader.scan_once("players", str(tmp_path / "atp_players.csv")))
        assert report.rows == {"read": 11, "dim_players": written}
        assert report.steps["malformed"] == 9
    assert (report.steps["repaired"], report.steps["quarantined"]) == (4, 5)
    assert report.audits["quarantined"].count() == 6
    ids = sorted(r.player_id for r in warehouse.table("dim_players").collect())
    assert ids == [1, 2, 3, 4, 9, 11]
