"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

State: pieces not placed yet, and sequences with the room left in them (gaps). A round sorts
both together by size over all tasks. Sweeping upwards, every gap takes the largest piece
below it that no smaller gap has taken: pieces are opening brackets, gaps closing ones, and
brackets match. Each task matches what meets inside its own range. What is left of a task is
gaps that want a piece from below, then pieces that want a gap from above; with the counts of
the tasks before it each of these has a rank, the nesting level of its bracket, and equal
ranks meet in one further exchange, at most two rows a task on each rank. Then gaps shrink,
and the next round begins. When a round places next to nothing, the largest pieces left open
new sequences, as many as the rest needs at least.

Each round is stored, so a lost executor costs no more than its part of one round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtledger.llm.common import keyed, stored
from courtledger.llm.subwords import ended_ids

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_SWEPT = "task int, kind int, id bigint, size bigint, seq bigint, gap bigint, rank bigint"
#: A round that places a smaller share of the pieces is followed by opening sequences.
LEAST_SHARE = 0.05
#: Small pieces to a sequence beyond which they are bundled.
MOST_SMALL = 8


def _cut(vocabulary_path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            texts = ended_ids(batch["text"], vocabulary_path, end_id)
            for doc, ids in zip(batch["doc_id"].to_pylist(), texts):
                ids = ids.astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b])))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def pieces(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int) -> DataFrame:
    """The ids of every document with ``end_id``, cut where longer than ``capacity``.

    All pieces but the first of a document are full. Null texts count as empty: one piece
    that holds the end. Repeated rows are documents of their own.
    """
    rows = keyed(docs).select("doc_id", "text")
    return rows.mapInArrow(_cut(vocabulary_path, end_id, capacity), _PIECES)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches brackets within a task. Kind 2: placed; 0 and 1: pieces and gaps left over;
    3: how many gaps and pieces these are, one row for the task."""
    task = TaskContext.get().partitionId()
    waiting: list[tuple[int, int]] = []
    unmet = 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * 6
        kinds = [pa.int32(), *[pa.int64()] * 5]
        arrays = [pa.array([task] * len(rows), pa.int32())]
        arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["task", "kind", "id", "size", "seq", "gap", "rank"])

    for batch in batches:
        out = []
        columns = (batch[c].to_pylist() for c in ("kind", "id", "size"))
        for kind, number, size in zip(*columns):
            if kind == 0:
                waiting.append((number, size))
            elif waiting:
                piece, length = waiting.pop()
                out.append((2, piece, length, number, size, None))
            else:
                unmet += 1
                out.append((1, number, size, None, None, unmet))
        yield batch_of(out)
    left = [(0, number, size, None, None, k + 1) for k, (number, size) in enumerate(waiting)]
    for at in range(0, len(left), 10_000):
        yield batch_of(left[at : at + 10_000])
    if left or unmet:
        yield batch_of([(3, unmet, len(left), None, None, None)])


def _round(state: DataFrame) -> DataFrame:
    """One sweep over all tasks: ``kind, id, size, seq, gap, level``.

    Kind 2: a piece with the sequence it goes to and the gap found there. Kinds 0 and 1:
    pieces, with their levels, and gaps that remain.
    """
    keys = ["size", "kind", "id"]
    swept = stored(
        state.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_sweep, _SWEPT),
        "swept",
    )
    level, bases = 0, []
    for row in sorted(swept.filter("kind = 3").select("task", "id", "size").collect()):
        bases.append((row.task, level, level - row.id))
        level += row.size - row.id
    spark = state.sparkSession
    # One row for each task of the sweep.
    bases = F.broadcast(spark.createDataFrame(bases, "task int, above bigint, below bigint"))
    # A gap closes the level it finds, a piece opens the next one.
    is_gap = F.col("kind") == 1
    ranked = (
        swept.filter("kind < 2")
        .join(bases, "task")
        .withColumn(
            "level",
            F.when(is_gap, F.col("above") - F.col("rank") + 1).otherwise(F.col("below") + F.col("rank")),
        )
    )
    order = Window.partitionBy("level").orderBy("task", F.desc("kind"))
    near = ranked.select(
        "kind",
        "id",
        "size",
        "level",
        F.lag(F.struct("kind", "id", "size")).over(order).alias("last"),
        F.lead("kind").over(order).alias("next"),
    ).filter(F.coalesce(is_gap | (F.col("next") == 0) | F.col("next").isNull(), F.lit(True)))
    meets = F.coalesce(is_gap & (F.col("last.kind") == 0), F.lit(False))
    across = near.select(
        F.when(meets, 2).otherwise(F.col("kind")).alias("kind"),
        F.when(meets, F.col("last.id")).otherwise(F.col("id")).alias("id"),
        F.when(meets, F.col("last.size")).otherwise(F.col("size")).alias("size"),
        F.when(meets, F.col("id")).alias("seq"),
        F.when(meets, F.col("size")).alias("gap"),
        "level",
    )
    inside = swept.filter("kind = 2").select(
        "kind", "id", "size", "seq", "gap", F.lit(None).cast("bigint").alias("level")
    )
    return stored(inside.unionByName(across), "round")


def _bundle(most: int):
    """Joins neighbours of a task's items into bundles of up to ``most`` together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, used = None, 0
        for batch in batches:
            bundles, inner = [], []
            for number, size in zip(batch["id"].to_pylist(), batch["size"].to_pylist()):
                if bundle is None or used + size > most:
                    bundle, used = number, 0
                bundles.append(bundle)
                inner.append(used)
                used += size
            arrays = [batch["id"], batch["size"], pa.array(bundles, pa.int64()), pa.array(inner, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "size", "bundle", "inner"])

    return run


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """``id, sequence_id, offset`` for ``id, size``: distinct numbers, sizes 1 to ``capacity``.

    A sequence is named by the item that opened it. Equal sizes go by number. Where small
    items outnumber the sequences by far, each would take a round of its own in a sequence;
    they are joined into bundles first, which are packed as one.
    """
    small = F.col("size") * 16 <= capacity
    tokens, tiny = items.agg(F.sum("size"), F.count_if(small)).first()
    if tiny <= MOST_SMALL * -(-(tokens or 0) // capacity):
        return _rounds(items, capacity)
    loose = items.filter(~small)
    bundled = stored(
        items.filter(small).mapInArrow(_bundle(capacity // 8), "id bigint, size bigint, bundle bigint, inner bigint"),
        "bundles",
    )
    bundles = bundled.groupBy(F.col("bundle").alias("id")).agg(F.sum("size").alias("size"))
    places = _rounds(loose.unionByName(bundles), capacity)
    inside = bundled.join(places.withColumnRenamed("id", "bundle"), "bundle").select(
        "id", "sequence_id", (F.col("offset") + F.col("inner")).alias("offset")
    )
    return places.join(loose.select("id"), "id").unionByName(inside)


def _rounds(items: DataFrame, capacity: int) -> DataFrame:
    at_start = F.lit(0).cast("bigint").alias("offset")

    def opened(openers: DataFrame) -> DataFrame:
        return openers.select("id", F.col("id").alias("sequence_id"), at_start)

    def gaps_of(openers: DataFrame) -> DataFrame:
        gaps = openers.select(F.lit(1).alias("kind"), "id", (capacity - F.col("size")).alias("size"))
        return gaps.filter("size > 0")

    # Two pieces of more than half never share a sequence.
    big = F.col("size") * 2 > capacity
    done = [opened(items.filter(big))]
    rest = items.filter(~big)
    many, least = rest.agg(F.count("*"), F.min("size")).first()
    state = gaps_of(items.filter(big)).unionByName(rest.select(F.lit(0).alias("kind"), "id", "size"))
    piece, gap, fits = F.col("kind") == 0, F.col("kind") == 1, F.col("kind") == 2
    room = F.when(fits, F.col("gap") - F.col("size")).when(gap, F.col("size"))
    while many:
        found = _round(state.filter(F.col("size") >= least))
        done.append(
            found.filter(fits).select(
                "id", F.col("seq").alias("sequence_id"), (capacity - F.col("gap")).alias("offset")
            )
        )
        now, tokens, top, smallest, free = found.agg(
            F.count_if(piece),
            F.sum(F.when(piece, F.col("size"))),
            F.max(F.when(piece, F.col("level"))),
            F.min(F.when(piece, F.col("size"))),
            F.coalesce(F.sum(F.when(room >= least, room)), F.lit(0)),
        ).first()
        gaps = found.filter(~piece).select(
            F.lit(1).alias("kind"), F.when(fits, F.col("seq")).otherwise(F.col("id")).alias("id"), room.alias("size")
        )
        rest = found.filter(piece)
        state = gaps
        if now > (1 - LEAST_SHARE) * many:
            opening = -(-(tokens - (0 if now == many else free)) // capacity)
            if opening > 0:
                # Pieces left over have the levels up to the highest, one each, by size.
                opens = rest.filter(F.col("level") > top - opening)
                done.append(opened(opens))
                state = state.unionByName(gaps_of(opens))
                rest = rest.filter(F.col("level") <= top - opening)
                now -= opening
        state = state.unionByName(rest.select("kind", "id", "size"))
        many, least = max(0, now), smallest
    return reduce(DataFrame.unionByName, done)


def pack(docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    An empty table gives no rows. Extra columns of the documents are not carried.
    """
    numbered = pieces(docs, vocabulary_path, end_id, capacity).withColumn(
        "id", F.monotonically_increasing_id()
    )
    cut = stored(numbered, "pieces")
    part = cut.filter(F.col("length") < capacity)
    places = best_fit(part.select("id", F.col("length").alias("size")), capacity)
    full = cut.filter(F.col("length") >= capacity)
    full = full.withColumns({"sequence_id": F.col("id"), "offset": F.lit(0).cast("bigint")})
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return part.join(places, "id").select(columns).unionByName(full.select(columns))
