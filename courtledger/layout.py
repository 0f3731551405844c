"""Where rows of a table lie, so that lookups by any of several columns open few files.

Sorting by one column after the other serves the first of them only. Here the values of each
column become cells of about equally many rows, and the bits of the cells interleaved are the place
of a row on a Z-order curve: rows close on it are close in every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtledger.session import stored

#: Bits of a cell number, so at most 256 cells for each column.
CELL_BITS = 8
_PLACE = "_place"


def cell_starts(df: DataFrame, expression: str, bits: int = CELL_BITS) -> list[tuple[int, object]]:
    """``(cell, smallest value)`` in order; at most ``2 ** bits`` cells, values of any sortable type.

    A value is in the cell of its rank, so cells run over all bits however few values there are:
    the highest bit halves the rows of every column. Distinct values are counted, ranged over tasks and added up by rank, so a value with a third of
    the rows is one count, and far values weigh no more than near ones. NULL is in no cell.
    """
    cells = 1 << bits
    counts = (
        df.select(F.expr(expression).alias("value"))
        .filter("value IS NOT NULL")
        .groupBy("value")
        .agg(F.count("*").alias("n"))
        .repartitionByRange("value")
        .sortWithinPartitions("value")
        .withColumn("task_no", F.spark_partition_id())
    )
    counts = stored(counts, "cell-counts")
    # One row for each task.
    tasks = counts.groupBy("task_no").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("task_no").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tasks = tasks.withColumns(
        {
            "earlier": F.coalesce(F.sum("rows").over(before), F.lit(0)),
            "total": F.sum("rows").over(everything),
        }
    )
    own = Window.partitionBy("task_no").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("smaller", F.coalesce(F.sum("n").over(own), F.lit(0)))
    cell = F.floor((F.col("earlier") + F.col("smaller")) * F.lit(cells) / F.col("total"))
    starts = ranked.join(tasks, "task_no").groupBy(cell.alias("cell")).agg(F.min("value").alias("start"))
    return sorted((row.cell, row.start) for row in starts.collect())


def cell_of(value: Column, starts: Sequence[tuple[int, object]], bits: int = CELL_BITS) -> Column:
    """The last cell that starts at or before a value; the first for smaller ones, 0 for NULL."""
    if not starts:
        return F.lit(0)
    numbers = F.array(*[F.lit(cell) for cell, _ in starts])
    bounds = F.array(*[F.lit(start) for _, start in starts])
    steps = F.array(*[F.lit(1 << b) for b in range(bits, -1, -1)])

    def step(passed: Column, size: Column) -> Column:
        next_start = F.get(bounds, passed + size - 1)
        return F.when(next_start <= value, passed + size).otherwise(passed)

    return F.get(numbers, F.greatest(F.aggregate(steps, F.lit(0), step) - 1, F.lit(0)))


def interleaved(cells: Sequence[Column], bits: int = CELL_BITS) -> Column:
    """One number of the bits of all cells, the highest bit of each first."""
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, cell in enumerate(reversed(cells)):
            own = F.shiftright(cell, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place.bitwiseOR(F.shiftleft(own, bit * len(cells) + k))
    return place


def along_curve(
    df: DataFrame,
    expressions: Sequence[str],
    first: Sequence[str],
    last: Sequence[str],
    files: int | None = None,
) -> DataFrame:
    """Rows ranged over tasks by ``first``, their place on the curve and ``last``, and sorted so.

    ``last`` should be a key: it lets a cell that holds much of the table be cut. ``df`` is read once
    for each expression, once for the range bounds and once for its rows, so give a stored table.
    ``files``: the number of ranges; otherwise adaptive execution decides.
    """
    names = [f"_cell_{k}" for k in range(len(expressions))]
    cells = {n: cell_of(F.expr(e), cell_starts(df, e)) for n, e in zip(names, expressions)}
    placed = df.withColumns(cells).withColumn(_PLACE, interleaved([F.col(n) for n in names])).drop(*names)
    order = [*first, _PLACE, *last]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop(_PLACE)


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Parquet writer options for Bloom filters, which pages too varied for a dictionary get.

    Their size follows the number of distinct values and ends at a megabyte for each row group.
    """
    if not columns:
        return {}
    enabled = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**enabled, "parquet.bloom.filter.adaptive.enabled": "true"}
