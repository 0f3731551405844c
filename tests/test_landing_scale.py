"""Landing does not deal lines by file, nor find out the file of a row for each row."""

import pytest

from courtledger.sources import fingerprint
from courtledger.sources.landing import _read_changed


@pytest.fixture
def long_and_short(tmp_path):
    """One file with nearly all lines, and one with two."""
    folder = tmp_path / "a b"
    folder.mkdir()
    lines = "".join(f"20240101,{n},{n},5\n" for n in range(20_000))
    (folder / "atp_rankings_20s.csv").write_text("ranking_date,rank,player,points\n" + lines)
    (folder / "atp_rankings_10s.csv").write_text("ranking_date,rank,player,points\n20140101,1,7,5\n")
    return str(tmp_path)


def test_lines_are_numbered_without_dealing_them_by_split(spark, long_and_short):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, 64 * 1024)  # less than the text
    try:
        plan = fingerprint(spark, long_and_short)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(conf, before)
    lines_join = next(line for line in plan.splitlines() if "Join" in line and "block" in line)
    assert "BroadcastHashJoin" in lines_join


def test_the_path_of_a_row_is_looked_up_by_file(spark, long_and_short):
    names = [f"a b/atp_rankings_{decade}0s.csv" for decade in (1, 2)]
    rows = _read_changed(spark, long_and_short, "rankings", names)
    assert "regexp" not in rows._jdf.queryExecution().optimizedPlan().toString()
    counts = {r["path"]: r["count"] for r in rows.groupBy("path").count().collect()}
    assert counts == {names[0]: 1, names[1]: 20_000}
