"""Places and running totals of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtledger.llm.common import fresh, ship, stored


def _running(sums: Sequence[str], place: str, task: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen, totals = TaskContext.get().partitionId(), 0, [0] * len(sums)
        for batch in batches:
            arrays, names = list(batch.columns), list(batch.schema.names)
            n = batch.num_rows
            arrays += [pa.array(np.full(n, number, np.int32)), pa.array(np.arange(seen, seen + n))]
            names += [task, place]
            seen += n
            for k, name in enumerate(sums):
                upto = np.cumsum(batch[name].to_numpy(zero_copy_only=False)) + totals[k]
                arrays.append(pa.array(upto - batch[name].to_numpy(zero_copy_only=False)))
                names.append(f"{name}_before")
                totals[k] = int(upto[-1]) if n else totals[k]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def ordered(
    df: DataFrame, order: Sequence[Column], label: str, sums: Sequence[str] = (), place: str = "place"
) -> DataFrame:
    """The rows with ``place`` (from 0) and, for each column of ``sums``, ``<name>_before``.

    Rows are ranged over tasks and sorted; every task numbers and adds up its own, which is
    stored, and is shifted by the sums of the tasks before it: one row for each task, the only
    thing the driver sees. The columns of ``sums`` are whole numbers without nulls. ``order``
    should be total, since rows that tie on it lie in one task.
    """
    ship(df.sparkSession)
    task = fresh(df, "task_no")
    extra = ", ".join([f"{task} int", f"{place} bigint", *(f"{s}_before bigint" for s in sums)])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_running(sums, place, task), f"{kinds}, {extra}"),
        label,
    )
    totals = (
        rows.groupBy(task)
        .agg(F.count("*").alias("n"), *[F.sum(s).alias(f"s{k}") for k, s in enumerate(sums)])
        .orderBy(task)
        .collect()
    )
    shift, shifts = [0] * (1 + len(sums)), []
    for row in totals:
        shifts.append((row[0], *shift))
        shift = [a + b for a, b in zip(shift, row[1:])]
    names = [place, *(f"{s}_before" for s in sums)]
    moves = df.sparkSession.createDataFrame(
        shifts, f"{task} int, " + ", ".join(f"`_by_{n}` bigint" for n in names)
    )
    # One row for each task.
    return rows.join(F.broadcast(moves), task).select(
        *df.columns, *[(F.col(n) + F.col(f"_by_{n}")).alias(n) for n in names]
    )
