"""Row numbers of hot groups and exact quantiles, against plain windows and numpy."""

import math
import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from courtledger.operators import numbering, profile, rankings
from courtledger.operators.numbering import number_rows


def skewed(spark, rows=6000):
    """A third of the rows in one group, another third in the NULL group."""
    return spark.range(rows, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 500 + 2)
        .cast("int")
        .alias("k"),
        (F.xxhash64("id") % 1000).alias("v"),
        "id",
    )


@pytest.mark.parametrize("descending", [False, True])
def test_hot_groups_get_the_numbers_of_a_window(spark, descending):
    df = skewed(spark)
    order = [F.desc("v") if descending else F.asc("v"), F.asc("id")]
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    routed = number_rows(df, ["k"], order, "n", hot_rows=1500)
    assert routed.schema["n"].dataType == plain.schema["n"].dataType
    assert routed.exceptAll(plain).isEmpty() and plain.exceptAll(routed).isEmpty()


def test_any_number_of_hot_groups(spark):
    df = spark.range(9000, numPartitions=4).select(F.pmod(F.xxhash64("id"), F.lit(1500)).alias("k"), "id")
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    routed = number_rows(df, ["k"], [F.col("id")], "n", hot_rows=2)
    assert routed.exceptAll(plain).isEmpty() and plain.exceptAll(routed).isEmpty()


def test_ranking_sequence_is_the_same_by_both_routes(spark, monkeypatch):
    raw = spark.range(5000).select(
        F.lit("20240101").alias("ranking_date"),
        (F.col("id") % 40).cast("int").alias("rank"),
        F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 300).cast("string")).alias("player"),
        (F.col("id") % 90).cast("int").alias("points"),
    )
    by_window = rankings.transform_rankings(raw)
    monkeypatch.setattr(numbering, "HOT_GROUP_ROWS", 1000)
    routed = rankings.transform_rankings(raw)
    assert by_window.exceptAll(routed).isEmpty() and routed.exceptAll(by_window).isEmpty()
    ends = routed.groupBy("ranking_date", "player_id").agg(
        F.count("*").alias("n"), F.max("ranking_sequence").alias("last"), F.min("ranking_sequence").alias("first")
    )
    assert ends.filter("n <> last OR first <> 1").isEmpty()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)),
            st.one_of(st.none(), st.floats(-1e6, 1e6, width=32)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_describe_numeric_is_exact(spark, values):
    df = spark.createDataFrame(values, "i int, f float")
    found = {r.column_name: r for r in profile.describe_numeric(df).collect()}
    for position, name in enumerate(["i", "f"]):
        column = pd.Series([v[position] for v in values if v[position] is not None], dtype="float64")
        if column.empty:
            assert name not in found
            continue
        got = found[name]
        assert got["count"] == len(column)
        for label, expected in [
            ("min", column.min()),
            ("max", column.max()),
            ("p25", column.quantile(0.25)),
            ("p50", column.quantile(0.5)),
            ("p75", column.quantile(0.75)),
            ("mean", column.mean()),
        ]:
            assert np.isclose(got[label], expected, rtol=1e-9, atol=1e-6), label
        if len(column) == 1:
            assert got["std"] is None
        else:
            assert np.isclose(got["std"], column.std(), rtol=1e-6, atol=1e-6)


def test_quartiles_interpolate(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4]], "v int")
    row = profile.describe_numeric(df).first()
    assert (row.p25, row.p50, row.p75) == (1.75, 2.5, 3.25)


@pytest.mark.parametrize("far", [1e30, float("inf"), float("-inf"), 0.0])
def test_one_value_far_away_does_not_gather_the_others(spark, far):
    """The histogram is spread by rank, so an outlier leaves no task with all other values."""
    close = spark.range(40_000).select((F.col("id") % 30_011 / 1e6).alias("v"))
    df = close.unionByName(spark.range(1).select(F.lit(far).alias("v")))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")  # so small a table would be one task again
    try:
        ranged = profile.ranged_histogram(profile.value_histogram(df, ["v"], "double"))
        shares = [r.n for r in ranged.groupBy("task_no").agg(F.count("*").alias("n")).collect()]
        assert len(shares) >= 6 and max(shares) < 0.3 * sum(shares)
        found = profile.describe_numeric(df).first()
    finally:
        spark.conf.set(conf, before)
    column = pd.Series([k % 30_011 / 1e6 for k in range(40_000)] + [far])
    assert [found.p25, found.p50, found.p75] == pytest.approx([column.quantile(q) for q in (0.25, 0.5, 0.75)])
    assert (found["count"], found.min, found.max) == (40_001, column.min(), column.max())


def test_quartiles_at_the_edge_of_infinity(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v, 1.0, None) for v in [-inf, 1.0, 2.0, inf, inf]], "v double, w double, x double")
    found = {r.column_name: r for r in profile.describe_numeric(df).collect()}
    assert (found["v"].p25, found["v"].p50, found["v"].p75, found["v"].max) == (1.0, 2.0, inf, inf)
    assert math.isnan(found["v"]["mean"]) and math.isnan(found["v"]["std"])
    assert (found["w"].p25, found["w"].std) == (1.0, 0.0) and "x" not in found


def test_columns_of_many_tasks_and_heavy_values(spark):
    """A value that holds most of a column, beside columns of few and of many values."""
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(
        {
            "hot": np.where(rng.random(5000) < 0.7, 3.0, rng.normal(0, 1, 5000)),
            "few": rng.integers(0, 3, 5000).astype(float),
            "many": rng.normal(0, 1e9, 5000),
        }
    )
    found = {r.column_name: r for r in profile.describe_numeric(spark.createDataFrame(frame)).collect()}
    for name in frame:
        for label, q in [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]:
            assert found[name][label] == pytest.approx(frame[name].quantile(q))
        assert found[name].std == pytest.approx(frame[name].std())
