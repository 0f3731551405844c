"""Benchmark decontamination: texts that hold a test item, up to a few edits.

A test item with an error budget of k edits is cut into k + 1 pieces. Whatever k edits do to
it, one piece stays as it is, so every match shows as an exact hit of a piece. All pieces of
all items are searched in one pass over a text; around each hit the whole item is then
matched by Myers' bit-parallel edit distance.

Items go to the tasks in blocks of a bounded size, each searched against all texts, so a
benchmark of any size works.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.llm.common import keyed, ship

#: Edits allowed for each hundred characters of an item.
ERROR_PERCENT = 5
#: Shorter items say too little: they occur by chance and are not searched.
MIN_ITEM_CHARS = 25
#: Characters of items that are sent to every task at once.
BLOCK_CHARS = 16 << 20


def normal(text: str) -> str:
    """Lower case, with single spaces for all white space."""
    return " ".join(text.lower().split())


def budget(length: int, percent: int) -> int:
    return length * percent // 100


def cut(item: str, pieces: int) -> list[tuple[int, str]]:
    """Places and texts of ``pieces`` pieces of nearly equal length."""
    edges = [len(item) * k // pieces for k in range(pieces + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(item: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any part of ``text``, and where that part ends."""
    size = len(item)
    masks: dict[str, int] = {}
    for k, char in enumerate(item):
        masks[char] = masks.get(char, 0) | 1 << k
    every, top = (1 << size) - 1, 1 << size - 1
    up, down, score = every, 0, size
    best, end = size, 0
    for place, char in enumerate(text, 1):
        match = masks.get(char, 0)
        across = match | down
        diagonal = ((match & up) + up ^ up) | match
        right = down | ~(diagonal | up) & every
        left = up & diagonal
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right = right << 1 & every
        left = left << 1 & every
        up = left | ~(across | right) & every
        down = right & across
        if score < best:
            best, end = score, place
    return best, end


class Searcher:
    """All pieces of a block of items, ready to be searched in texts."""

    def __init__(self, items: list[tuple[int | None, str]], percent: int):
        self.items = items
        self.budgets = [budget(len(text), percent) for _, text in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(items):
            for place, piece in cut(text, self.budgets[number] + 1):
                where.setdefault(piece, []).append((number, place))
        self.pieces = ahocorasick.Automaton()
        for piece, places in where.items():
            self.pieces.add_word(piece, (len(piece), places))
        self.pieces.make_automaton()

    def search(self, text: str) -> list[tuple[int | None, int, int]]:
        """``item_id, distance, end`` for each item found, at its best place in the normal text."""
        if not len(self.pieces):
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (size, places) in self.pieces.iter(text):
            for number, place in places:
                start = last + 1 - size - place
                edits = self.budgets[number]
                windows.setdefault(number, []).append(
                    (max(0, start - edits), start + len(self.items[number][1]) + edits)
                )
        found = []
        for number, spans in windows.items():
            item_id, item = self.items[number]
            merged: list[list[int]] = []
            for low, high in sorted(spans):  # each place of the text is matched once
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(high, merged[-1][1])
                else:
                    merged.append([low, high])
            best = min((*myers(item, text[low:high]), low) for low, high in merged)
            if best[0] <= self.budgets[number]:
                found.append((item_id, best[0], best[1] + best[2]))
        return found


_searchers: dict[int, Searcher] = {}


def _searcher(shared, percent: int) -> Searcher:
    """The worker's searcher for a block of items; it outlives a task."""
    if shared.id not in _searchers:
        _searchers.clear()
        _searchers[shared.id] = Searcher(shared.items.value, percent)
    return _searchers[shared.id]


class _Block:
    """A block of items as sent to the tasks."""

    def __init__(self, number: int, items):
        self.id, self.items = number, items


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[_Block]:
    """Distinct normal items in blocks of about ``block_chars``; null and short texts are none."""
    ship(benchmark.sparkSession)
    items = benchmark.select(
        benchmark["item_id"].cast("bigint").alias("item_id"), benchmark["text"].alias("text")
    ).filter(F.length("text") >= MIN_ITEM_CHARS).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    for number in range(blocks):
        # About block_chars characters, whatever the size of the benchmark.
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        texts = sorted(((r.item_id, normal(r.text)) for r in rows), key=lambda x: (x[0] is None, x))
        texts = [x for x in texts if len(x[1]) >= MIN_ITEM_CHARS]
        if texts:
            shared = benchmark.sparkSession.sparkContext.broadcast(texts)
            yield _Block(shared._jbroadcast.id(), shared)


def _pairs(block: _Block, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(block, percent)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                for item, distance, end in searcher.search(normal(text.as_py())):
                    rows.append((doc.as_py(), item, distance, end))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "item_id", "distance", "end"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def leaks(
    docs: DataFrame, benchmark: DataFrame, percent: int = ERROR_PERCENT, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``doc_id, item_id, distance, end``: every item found in every row, at its best match.

    ``end`` is the place in the normal text behind the match. Null and empty texts hold
    nothing; items of less than ``MIN_ITEM_CHARS`` characters are not searched; items that
    repeat an id and a text are one. Repeated rows are found each. Without items there are no
    rows.
    """
    schema = "doc_id bigint, item_id bigint, distance int, end bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    rows = keyed(docs).select("doc_id", "text")
    for block in _blocks(benchmark, block_chars):
        found = found.unionByName(rows.mapInArrow(_pairs(block, percent), schema))
    return found


def _without(block: _Block, percent: int, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(block, percent)
        for batch in batches:
            clean = [not searcher.search(normal(t.as_py() or "")) for t in batch.column(place)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, percent: int = ERROR_PERCENT, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The documents that hold no item, with all their columns, in one pass for each block."""
    for block in _blocks(benchmark, block_chars):
        docs = docs.mapInArrow(_without(block, percent, docs.columns.index("text")), docs.schema)
    return docs
