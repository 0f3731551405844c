"""Places on a curve, the index of files, and lookups through them."""

import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from courtledger.layout import along_curve, bloom_options, cell_of, cell_starts, interleaved
from courtledger.operators.clean import add_audit_columns
from courtledger.plans.queries import QUERIES
from courtledger.schemas import TABLES
from courtledger.snapshots import SnapshotTable
from courtledger.warehouse import Warehouse

NOW = datetime(2025, 2, 1, 2, 0, 0)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"t_{uuid.uuid4().hex}", str(tmp_path / "tables"))


def rankings(spark, days=360, players=40, year=2024):
    """Each player on each of many days."""
    rows = spark.range(days * players).select(
        F.date_add(F.lit(date(year, 1, 1)), (F.col("id") / players).cast("int")).alias("ranking_date"),
        (F.col("id") % players).cast("int").alias("player_id"),
        F.lit(1).alias("rank"),
        F.lit(1).alias("points"),
        F.lit(1).alias("ranking_sequence"),
    )
    return add_audit_columns(rows, "f", NOW)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1] * 600 + [2, 3, 4] + [10**9], [(0, 1), (3, 2)]),
        ([5, 5, None, None], [(0, 5)]),
        ([None], []),
        ([], []),
        (list(range(8)), [(0, 0), (1, 2), (2, 4), (3, 6)]),
    ],
)
def test_cells_follow_ranks(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert cell_starts(df, "v", bits=2) == expected


def test_cells_of_text_and_dates(spark):
    df = spark.createDataFrame([(f"{k:03}", date(2024, 1, 1 + k % 28)) for k in range(256)], "t string, d date")
    assert cell_starts(df, "t", bits=3) == [(k, f"{32 * k:03}") for k in range(8)]
    assert [start for _, start in cell_starts(df, "d", bits=8)] == [date(2024, 1, 1 + k) for k in range(28)]


@pytest.mark.parametrize("count", [1, 2, 3, 7, 255, 256])
def test_cell_is_the_last_that_starts_at_or_before(spark, count):
    starts = [(k - 1, 10 * k) for k in range(1, count + 1)]
    values = [None, -1, 0, 9, 10, 11, 19, 20, 10 * count - 1, 10 * count, 10**6]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = [r.c for r in df.select(cell_of(F.col("v"), starts).alias("c")).collect()]
    assert found == [max(sum(s <= v for _, s in starts) - 1, 0) if v is not None else 0 for v in values]


def test_bits_interleave(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for a, b, place in df.select("a", "b", interleaved([F.col("a"), F.col("b")], bits=3)).collect():
        assert place == int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}")), 2)


def test_rows_stay_whole_with_nulls_repeats_and_empty_tables(spark):
    given = [(None, None), (1, "a"), (1, "a"), (2, None), (None, "b")] * 3
    df = spark.createDataFrame(given, "n int, t string")
    for rows in (df, df.limit(0)):
        placed = along_curve(rows, ["n", "t"], [], ["n", "t"], files=3)
        assert sorted(map(repr, placed.collect())) == sorted(map(repr, rows.collect()))
        assert placed.columns == df.columns


def test_lookups_open_fewer_files_than_in_key_order(spark, warehouse):
    table = warehouse.snapshots("fact_rankings")
    opened = {}
    for curve in (True, False):
        warehouse.write("fact_rankings", rankings(spark), files=64, curve=curve)
        assert warehouse.table("fact_rankings").count() == 360 * 40
        for asked, n in (({"player_id": 7}, 360), ({"ranking_date": date(2024, 5, 5)}, 40)):
            (names,) = table.files_with(asked).values()
            opened[curve, *asked] = len(names)
            assert warehouse.lookup("fact_rankings", **asked).count() == n
    # Key order starts with the date and so serves dates best, players not at all.
    assert opened[False, "player_id"] >= 60
    assert opened[True, "player_id"] <= 20 and opened[True, "ranking_date"] <= 20


def test_lookups_follow_the_commit(spark, warehouse):
    both = rankings(spark, days=30).unionByName(rankings(spark, days=30, year=2023))
    warehouse.write("fact_rankings", both, files=8)
    warehouse.write("fact_rankings", rankings(spark, days=10, players=3), replace_all=False)
    years = warehouse.lookup("fact_rankings", player_id=2).groupBy("ranking_year").count()
    assert dict(years.collect()) == {2023: 30, 2024: 10}
    assert warehouse.lookup("fact_rankings", player_id=2, ranking_date=date(2024, 1, 3)).count() == 1
    assert warehouse.lookup("fact_rankings", player_id=999).isEmpty()
    with pytest.raises(ValueError, match="looked up by"):
        warehouse.lookup("fact_rankings", points=1)
    stored = TABLES["fact_rankings"].stored.fieldNames()
    assert warehouse.lookup("fact_rankings", player_id=2).columns == stored


def test_varied_columns_get_bloom_filters(spark, tmp_path):
    rows = spark.range(300_000).select(F.hash("id").alias("player_id"), F.lit(1).alias("rank"))
    table = SnapshotTable(spark, str(tmp_path / "t"), rows.schema, None, ["player_id"])
    (part,) = table.stage(rows.coalesce(1), bloom_options(["player_id"])).values()
    assert part.rows == 300_000
    folder = f"{table.path}/data/snapshot={part.snapshot}"
    (name,) = [n for n in table.files.names(folder) if n.endswith(".parquet")]
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    conf = spark._jsc.hadoopConfiguration()
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
    )
    try:
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        assert columns.get(0).getBloomFilterOffset() > 0 >= columns.get(1).getBloomFilterOffset()
    finally:
        reader.close()


def test_lookups_of_the_sink_open_fewer_files_by_date_and_tournament(spark):
    found = {}
    for row in QUERIES["sink_lookup_files"](spark, "/root/testdata/sf0.01").collect():
        key, curve = found.get(row.column_name, (0, 0))
        found[row.column_name] = (key + row.opened_key_order, curve + row.opened_curve)
        assert row.opened_curve < row.files_curve and row.opened_key_order < row.files_key_order
    for column in ("tourney_date", "tourney_id"):
        key, curve = found[column]
        assert curve < key
