"""Tables that change all at once, whatever cuts a write off."""

import json
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from courtledger.operators.clean import add_audit_columns
from courtledger.schemas import TABLES
from courtledger.snapshots import ConcurrentWrite, Part, SnapshotTable
from courtledger.warehouse import Warehouse

NOW = datetime(2025, 2, 1, 2, 0, 0)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "tables"))


def rankings(spark, *given):
    return add_audit_columns(spark.createDataFrame(list(given), TABLES["fact_rankings"].columns), "f", NOW)


def row(year, player, points=10):
    return (date(year, 1, 1), player, 1, points, 1)


def found(df):
    return sorted((r.ranking_date.year, r.player_id, r.points) for r in df.collect())


def test_a_write_that_dies_between_files_changes_nothing(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, row(2023, 1), row(2024, 2)))
    folder = f"{warehouse.path}/fact_rankings/data"
    before, files = warehouse.metadata().collect(), warehouse.snapshots("fact_rankings").files
    # Some tasks finish their files; the one that meets player 777 fails.
    many = spark.range(2000).select(
        F.lit(date(2024, 1, 1)).alias("ranking_date"), F.col("id").cast("int").alias("player_id"),
        F.lit(1).alias("rank"), F.lit(1).alias("points"), F.lit(1).alias("ranking_sequence"),
    )
    late = F.udf(lambda p: 1 // (p != 777) if p is not None else None, "int")
    broken = add_audit_columns(many, "f", NOW).repartition(8)
    table = warehouse.snapshots("fact_rankings")
    staged = broken.withColumn("ranking_year", F.lit(2024)).withColumn("points", late("player_id"))
    with pytest.raises(Exception, match="ZeroDivision|division"):
        table.stage(staged.select(*TABLES["fact_rankings"].stored.fieldNames()))
    assert len(files.names(folder)) == 2  # what the dead write left
    assert found(warehouse.table("fact_rankings")) == [(2023, 1, 10), (2024, 2, 10)]
    assert warehouse.metadata().collect() == before
    assert spark.table(f"{warehouse.database}.fact_rankings").count() == 2
    warehouse.write("fact_rankings", rankings(spark, row(2025, 5)))
    assert found(warehouse.table("fact_rankings")) == [(2025, 5, 10)]
    assert len(table.expire(older_than=0)) == 2 and len(files.names(folder)) == 1
    assert found(warehouse.table("fact_rankings")) == [(2025, 5, 10)]


def test_a_write_that_dies_before_its_commit_changes_nothing(spark, warehouse, monkeypatch):
    warehouse.write("fact_rankings", rankings(spark, row(2023, 1)))
    with monkeypatch.context() as patch:
        patch.setattr(SnapshotTable, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            warehouse.write("fact_rankings", rankings(spark, row(2024, 2)))
    assert found(warehouse.table("fact_rankings")) == [(2023, 1, 10)]


def test_a_reader_keeps_the_table_it_began_with(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, row(2023, 1)))
    began = warehouse.table("fact_rankings")
    warehouse.write("fact_rankings", rankings(spark, row(2024, 2)))
    assert found(began) == [(2023, 1, 10)]
    table = warehouse.snapshots("fact_rankings")
    assert found(table.read(1)) == [(2023, 1, 10)] and found(table.read()) == [(2024, 2, 10)]


def test_years_come_from_their_own_snapshots(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, row(2022, 1), row(2023, 1), (None, 9, 1, 10, 1)))
    warehouse.write("fact_rankings", rankings(spark, row(2023, 2), row(2024, 3)), replace_all=False)
    table = warehouse.table("fact_rankings")
    assert sorted(r.player_id for r in table.collect()) == [1, 2, 3, 9]
    view = spark.table(f"{warehouse.database}.fact_rankings")
    assert view.schema.simpleString() == table.schema.simpleString()
    assert sorted(r.player_id for r in view.collect()) == [1, 2, 3, 9]
    commit = warehouse.snapshots("fact_rankings").current()
    assert (commit.rows, len(commit.snapshots)) == (4, 2)
    assert warehouse.snapshots("fact_rankings").expire(older_than=0) == []
    warehouse.write("fact_rankings", rankings(spark, (None, 8, 1, 10, 1)), replace_all=False)
    assert sorted(r.player_id for r in warehouse.table("fact_rankings").collect()) == [1, 2, 3, 8]


def test_two_writers_do_not_lose_a_commit(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, row(2023, 1)))
    table = warehouse.snapshots("fact_rankings")
    base = table.current()
    table.commit(base, base.parts)
    with pytest.raises(ConcurrentWrite):
        table.commit(base, {})
    assert found(warehouse.table("fact_rankings")) == [(2023, 1, 10)]
    names = table.files.names(f"{table.path}/commits")
    assert not [n for n in names if n.startswith(".draft")]


def test_empty_tables_and_empty_writes(spark, warehouse):
    with pytest.raises(LookupError):
        warehouse.table("dim_players")
    warehouse.create(["fact_rankings", "dim_players"])
    warehouse.create(["fact_rankings"])
    for name in ("fact_rankings", "dim_players"):
        assert warehouse.table(name).schema == TABLES[name].stored
        assert spark.table(f"{warehouse.database}.{name}").count() == 0
    warehouse.write("fact_rankings", rankings(spark, row(2023, 1)))
    warehouse.write("fact_rankings", rankings(spark))
    assert warehouse.table("fact_rankings").isEmpty()
    assert spark.table(f"{warehouse.database}.fact_rankings").isEmpty()
    players = spark.createDataFrame([], TABLES["dim_players"].columns)
    warehouse.write("dim_players", add_audit_columns(players, "f", NOW))
    assert warehouse.table("dim_players").isEmpty()


def test_commits_record_what_they_hold(spark, warehouse):
    warehouse.write("fact_rankings", rankings(spark, *[row(2023, p) for p in range(50)], row(2024, 1)))
    table = warehouse.snapshots("fact_rankings")
    commit = table.current()
    assert {name: part.rows for name, part in commit.parts.items()} == {"2023": 50, "2024": 1}
    assert all(isinstance(part, Part) and part.bytes > 0 for part in commit.parts.values())
    record = json.loads(table.files.read(f"{table.path}/commits/{commit.number:012d}.json"))
    assert set(record) == {"at", "parts"}
