"""Hard negatives against comparing every anchor with every row."""

import math

import duckdb
import numpy as np
import pytest

from courtledger.llm import negatives
from courtledger.llm.negatives import Cells, Codebooks, MultiIndex, hard_negatives, indexed_rows
from courtledger.llm.queries import QUERIES

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id bigint, embedding array<float>, label int, no bigint, cell string"


def reckoned(rows):
    usable = []
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        usable.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    by_id = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for k, (anchor, label, q) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scores = [(sum(a * b for a, b in zip(q, r)), v, kind) for j, (v, kind, r) in enumerate(usable) if j != k]
        for score, positive, _ in sorted((s for s in scores if s[2] == label), key=by_id)[:5]:
            inside = [s for s in scores if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score]
            for rank, (other, negative, _) in enumerate(sorted(inside, key=by_id)[:10], 1):
                out.append((anchor, positive, rank, negative, score, other))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    centres = rng.normal(0, 1, (6, 9))
    for k in range(1500):
        vector = (centres[k % 6] * 0.5 + rng.normal(0, 0.6, 9)).astype(np.float32).tolist()
        out.append((k, vector, int(rng.integers(0, 4)), 1, "x"))
    out += [(2000, [1.0] * 9, 1, 1, "x")] * 300  # copies, the anchor among them
    out += [(2001 + k, [1.0] * 9, 2, 1, "x") for k in range(300)]
    out += [(None, [0.9] * 9, 2, 1, "x"), (None, [0.9] * 9, 1, 1, "x")]
    out += [(3000, None, 1, 1, "x"), (3100, [1.0] * 9, None, 1, "x"), (3200, [float("nan")] * 9, 1, 1, "x")]
    out += [(3300, [1.0, None], 1, 1, "x"), (3400, [float("inf")] * 9, 1, 1, "x"), (3500, [2.0, 1.0], 3, 1, "x")]
    out += [(3600, [], 1, 1, "x"), (3700, [-1.0] * 9, 9, 1, "x"), (3800, [0.0] * 9, 2, 1, "x")]
    return out


@pytest.mark.parametrize("first, block", [(4096, 32_768), (40, 64)])
def test_negatives(spark, rows, monkeypatch, first, block):
    """Also with small blocks, where most cells are visited only if their bound says so."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "FIRST_ROWS", first)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(hard_negatives(docs)) == reckoned(rows)


def test_empty(spark, rows):
    docs = spark.createDataFrame(rows[:3], SCHEMA)
    assert found(hard_negatives(docs.limit(0))) == []
    assert found(hard_negatives(docs)) == reckoned(rows[:3])


def test_large_components(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (rng.normal(0, 1, 8) * 60_000 / 5).astype(np.float32).tolist(), k % 2, 1, "x") for k in range(300)]
    assert found(hard_negatives(spark.createDataFrame(rows, SCHEMA))) == reckoned(rows)


def test_heap_bounds_every_row_and_descends(spark, rows):
    index = MultiIndex(indexed_rows(spark.createDataFrame(rows[:900], SCHEMA)).cache())
    cells: Cells = index.cells.value
    books: Codebooks = cells.books
    vectors = np.array([[math.floor(256 * x) for x in r[1]] for r in rows[:900]], np.int32)
    of, _ = books.assign(vectors)
    for anchor in vectors[:20]:
        heap = list(cells.heap(anchor))
        bounds = [b for b, _ in heap]
        assert bounds == sorted(bounds, reverse=True)
        assert {c for _, c in heap} == set(of.tolist())
        by_cell = {c: b for b, c in heap}
        scores = vectors.astype(np.int64) @ anchor
        assert all(s <= by_cell[c] for s, c in zip(scores.tolist(), of.tolist()))


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    columns = ", ".join(COLUMNS)
    expected = connection.sql(f"SELECT {columns} FROM ({negatives.ORACLE})").fetchall()
    assert found(QUERIES["op12_negatives"](spark, folder)) == sorted(expected, key=str) and expected
