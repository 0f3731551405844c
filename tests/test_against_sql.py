"""Every registered query against its SQL, at the smallest scale."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from courtledger.operators import numbering
from courtledger.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(rows):
    return sorted(repr(tuple(row)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    rows = result.select(*[f"`{c}`" for c in columns]).collect()
    if name not in oracle_sql():
        assert rows
        return
    sql = oracle_sql()[name]
    assert sorted(duck.sql(sql).columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {quoted} FROM ({sql})").fetchall()
    assert comparable(rows) == comparable(expected)


@pytest.mark.parametrize("name", ["transform_rankings", "duplicate_rows", "load_history"])
def test_query_with_every_large_group_split(spark, duck, monkeypatch, name):
    """The same results when days and players count as hot from a few rows on."""

    monkeypatch.setattr(numbering, "HOT_GROUP_ROWS", 3)
    test_query(spark, duck, name)


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
