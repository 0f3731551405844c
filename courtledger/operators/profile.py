"""Profiling of a table: missing values, distributions, keys, dates, participation.

Everything starts from one narrow read of the table and an aggregation that combines
map-side; values are counted before they are ranked, so repeated values cost one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtledger.functions import percent, ratio, score_residue
from courtledger.session import stored

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _columns_of(df: DataFrame, kind: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, their count and their share in percent."""
    total = "_total"
    counted = df.agg(
        F.count("*").alias(total), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("missing_count"),
                percent(F.col(c), F.col(total), 2).alias("missing_pct"),
            )
            for c in df.columns
        ]
    )
    return (
        counted.select(F.inline(rows))
        .filter(F.col("missing_count") > 0)
        .orderBy(F.desc("missing_count"), "column_name")
    )


def value_histogram(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """``(column_name, value, n)`` of all the columns, NULL and NaN left out, from one read."""
    present = F.col("value").isNotNull()
    if kind == "double":
        present = present & ~F.isnan("value")
    return (
        df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .filter(present)
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Frequencies per column; with ``top``, the most frequent values of each column.

    The per-column limit is applied by every task before rows are exchanged.
    """
    counted = value_histogram(df, columns, "string")
    if top is None:
        return counted
    window = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return (
        counted.withColumn("place", F.row_number().over(window))
        .filter(F.col("place") <= top)
        .drop("place")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency of text columns."""
    columns = columns or _columns_of(df, T.StringType)
    first = F.min(F.struct((-F.col("n")).alias("rarity"), "value"))
    return (
        value_histogram(df, columns, "string")
        .groupBy("column_name")
        .agg(F.sum("n").alias("count"), F.count("*").alias("unique"), first.alias("first"))
        .select(
            "column_name",
            "count",
            "unique",
            F.col("first.value").alias("top"),
            (-F.col("first.rarity")).alias("freq"),
        )
    )


def ranged_histogram(histogram: DataFrame) -> DataFrame:
    """The histogram in order of column and value over tasks, stored with the task's number.

    Ranges follow the values there are, not their distances: a column whose values lie close
    together but for one far away, or infinite, is spread over as many tasks as any other.
    """
    order = ["column_name", "value"]
    ranged = histogram.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.withColumn("task_no", F.spark_partition_id()), "ranged")


def _interpolated(low: Column, high: Column, fraction: Column) -> Column:
    # Written so that an infinity on one side only counts where it has weight.
    return F.when((fraction == 0) | (low == high), low).otherwise(low + (high - low) * fraction)


def order_statistics(ranged: DataFrame, totals: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles of each column of a ranged histogram.

    ``totals``: ``column_name, task_no, count``, the rows behind the values of a column in a
    task. Added up over the tasks before, they say which task holds a position of the sorted
    column; only there values are counted one after the other, and the one at the position is
    picked. Positions are whole numbers, and so are all sums.
    """
    before = Window.partitionBy("column_name").orderBy("task_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each column and task that has some of it.
    tasks = totals.withColumn("earlier", F.coalesce(F.sum("count").over(before), F.lit(0)))
    counts = totals.groupBy("column_name").agg(F.sum("count").alias("total"))
    ends = F.array(
        *[
            F.struct(
                F.lit(name).alias("quantile"),
                F.lit(end).alias("end"),
                cut((F.col("total") - 1) * q).cast("bigint").alias("position"),
                ((F.col("total") - 1) * q - F.floor((F.col("total") - 1) * q)).alias("fraction"),
            )
            for name, q in wanted.items()
            for end, cut in [("low", F.floor), ("high", F.ceil)]
        ]
    )
    inside = (F.col("earlier") <= F.col("position")) & (F.col("position") < F.col("earlier") + F.col("count"))
    located = (
        tasks.join(counts.select("column_name", F.inline(ends)), "column_name")
        .filter(inside)
        .select(
            "column_name", "task_no", "quantile", "end", "fraction", (F.col("position") - F.col("earlier")).alias("position")
        )
    )
    place = ["column_name", "task_no"]
    # Two rows for each column and quantile at most, so both are broadcast.
    asked = F.broadcast(located.select(*place).distinct())
    running = Window.partitionBy(*place).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = ranged.join(asked, place, "left_semi").withColumn("upto", F.sum("n").over(running))
    holds = (F.col("upto") - F.col("n") <= F.col("position")) & (F.col("position") < F.col("upto"))

    def at_end(name: str, end: str) -> Column:
        return F.max(F.when((F.col("quantile") == name) & (F.col("end") == end), F.col("value")))

    def fraction(name: str) -> Column:
        return F.max(F.when(F.col("quantile") == name, F.col("fraction")))

    picked = values.join(F.broadcast(located), place).filter(holds)
    return picked.groupBy("column_name").agg(
        *[_interpolated(at_end(n, "low"), at_end(n, "high"), fraction(n)).alias(n) for n in wanted]
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum.

    The table is read once, for the counts per distinct value. Those are sorted over tasks and
    stored, and read three times: for sums per task, for the spread around the mean, and, in the
    tasks that hold a quartile, for its value. Infinities are values like any other; NaN and NULL
    are none. The mean of a column with infinities is infinite or NaN, and its deviation NaN.
    """
    columns = columns or _columns_of(df, T.NumericType)
    ranged = ranged_histogram(value_histogram(df, columns, "double"))
    # One row for each column and task that has some of it.
    totals = stored(
        ranged.groupBy("column_name", "task_no").agg(
            F.sum("n").alias("count"),
            F.sum(F.col("value") * F.col("n")).alias("sum"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        ),
        "totals",
    )
    summary = totals.groupBy("column_name").agg(
        F.sum("count").alias("count"),
        (F.sum("sum") / F.sum("count")).alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )
    # One row per column.
    spread = (
        ranged.join(F.broadcast(summary.select("column_name", "mean")), "column_name")
        .groupBy("column_name")
        .agg(F.sum(F.col("n") * F.pow(F.col("value") - F.col("mean"), 2)).alias("squares"))
    )
    return (
        summary.join(spread, "column_name")
        .join(order_statistics(ranged, totals, QUARTILES), "column_name")
        .select(
            "column_name",
            "count",
            "mean",
            F.sqrt(ratio(F.col("squares"), F.col("count") - 1)).alias("std"),
            "min",
            *QUARTILES,
            "max",
        )
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys. NULL is no key."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(key).alias("unique_keys"))
        .select(
            "total",
            "unique_keys",
            (F.col("total") - F.col("unique_keys")).alias("duplicates"),
            (F.col("total") == F.col("unique_keys")).alias("is_unique"),
        )
    )


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether the keys identify a row. Rows with a NULL key form no combination."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count_if(whole).alias("unique_combinations"),
        )
        .withColumn("is_grain", F.col("total") == F.col("unique_combinations"))
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All members of groups that share their keys; NULL equals NULL.

    Repeated keys are found by counting and joined back, so a group is never
    brought together: a skewed key is split by the join, not by a window.
    """
    repeated = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
        .select(*[F.col(k).alias(f"_{k}") for k in keys])
    )
    same = F.lit(True)
    for key in keys:
        same = same & df[key].eqNullSafe(repeated[f"_{key}"])
    return df.join(repeated, same, "left_semi")


def date_coverage(df: DataFrame, date: str) -> DataFrame:
    """First and last date, days between, distinct dates, and rows per date."""
    return (
        df.groupBy(date)
        .agg(F.count("*").alias("n"))
        .agg(
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
            F.count(date).alias("distinct_dates"),
            F.sum("n").alias("total"),
        )
        .select(
            "first_date",
            "last_date",
            F.date_diff("last_date", "first_date").alias("span_days"),
            "distinct_dates",
            ratio(F.col("total"), F.col("distinct_dates")).alias("avg_rows_per_date"),
        )
    )


def participation(matches: DataFrame, top: int | None = None) -> DataFrame:
    """Matches per player name, both sides from one read; with ``top``, the busiest players."""
    played = (
        matches.select(F.explode(F.array("winner_name", "loser_name")).alias("player_name"))
        .filter(F.col("player_name").isNotNull())
        .groupBy("player_name")
        .agg(F.count("*").alias("matches"))
    )
    return played if top is None else played.orderBy(F.desc("matches"), "player_name").limit(top)


def participation_summary(matches: DataFrame) -> DataFrame:
    """Number of different players and their appearances."""
    return participation(matches).agg(
        F.count("*").alias("unique_players"), F.sum("matches").alias("appearances")
    )


def hand_distribution(players: DataFrame) -> DataFrame:
    return players.agg(
        F.count_if(F.col("hand") == "R").alias("right_handed"),
        F.count_if(F.col("hand") == "L").alias("left_handed"),
    ).withColumn("right_left_ratio", ratio(F.col("right_handed"), F.col("left_handed")))


def score_tokens(matches: DataFrame) -> DataFrame:
    """Outcome words that occur in scores, and in how many matches."""
    return (
        matches.select(score_residue(F.col("score")).alias("token"))
        .filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.count("*").alias("matches"))
    )


def issue_summary(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Findings over the raw tables: one row per issue that occurs."""

    def issue(table: str, name: str, n: str, total: str) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("issue"),
            F.col(n).alias("issue_rows"),
            percent(F.col(n), F.col(total), 1).alias("share_pct"),
        )

    critical = ["player_id", "name_first", "name_last"]
    counted = (
        players.groupBy("player_id")
        .agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in critical])
        .agg(
            F.sum("n").alias("total"),
            (F.sum("n") - F.count("player_id")).alias("dupes"),
            *[F.sum(f"no_{c}").alias(f"no_{c}") for c in critical],
        )
    )
    player_issues = counted.select(
        F.inline(
            F.array(
                issue("players", "duplicate player_id", "dupes", "total"),
                *[issue("players", f"missing {c}", f"no_{c}", "total") for c in critical],
            )
        )
    )
    match_issues = matches.agg(
        F.count_if(F.col("score").isNull()).alias("no_score"), F.count("*").alias("total")
    ).select(F.inline(F.array(issue("matches", "missing score", "no_score", "total"))))
    return player_issues.unionByName(match_issues).filter(F.col("issue_rows") > 0)
