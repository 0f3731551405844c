"""Row numbers within groups that stay parallel when one group holds most rows.

A window sends each group to one task. That is right for the many small groups and
wrong for a group with a third of the table. So groups of many rows are numbered apart:
they are sorted across tasks by range, numbered by position inside each task, and shifted
by the rows of the same group in earlier tasks. Groups are counted, all of them, and both
ways give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtledger.session import stored

#: Rows of a group that one task sorts without trouble.
HOT_GROUP_ROWS = 2_000_000


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[f"_{name}"])
    return condition


def _prefixed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: f"_{name}" for name in names})


def _number_by_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    sort = [*[F.col(k) for k in keys], *order]
    # Range bounds come from sampling, so the sorted rows are stored before they are read
    # twice.
    placed = stored(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumns(
            {"task_no": F.spark_partition_id(), "position": F.monotonically_increasing_id()}
        ),
        "placed",
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("task_no")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per task, and one per further hot group in it.
    runs = (
        placed.groupBy("task_no", *keys)
        .agg(F.min("position").alias("start"), F.count("*").alias("n"))
        .withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("start") + 1)
        .select("task_no", *keys, "shift")
    )
    names = ["task_no", *keys]
    runs = _prefixed(runs, names)
    return placed.join(runs, _same(placed, runs, names)).select(
        *df.columns, (F.col("position") + F.col("shift")).cast("int").alias(name)
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` as column ``name``.

    ``order`` should be total: rows that tie on it cannot be spread over tasks. The rows are
    stored once, since they are read to count the groups and to number them. Hot groups stay
    a table, however many there are; none of their keys comes to the driver. ``hot_rows``:
    from how many rows on a group is hot.
    """
    hot_rows = hot_rows or HOT_GROUP_ROWS
    rows = stored(df, "to-number")
    hot = (
        rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= hot_rows).drop("_n")
    )
    hot = _prefixed(stored(hot, "hot-groups"), keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    numbered = F.row_number().over(window)
    if hot.isEmpty():
        return rows.withColumn(name, numbered)
    match = _same(rows, hot, keys)
    return (
        rows.join(hot, match, "left_anti")
        .withColumn(name, numbered)
        .unionByName(_number_by_position(rows.join(hot, match, "left_semi"), keys, order, name))
    )
