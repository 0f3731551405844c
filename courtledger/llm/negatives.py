"""Hard negatives by an inverted multi-index with certified windows.

Vectors become whole numbers and are cut into two halves, each with a codebook of its own; a
vector's two codes name its cell. An anchor's inner product with any vector of a cell is at most
the sum of two half bounds: the product with the code, plus the anchor's length times the radius
of the code (the largest distance of a vector that has it). The multi-sequence heap names cells
in descending order of that sum.

* Every anchor first visits the cells at the head of its heap. Scores found there are scores it
  can count on; then it goes on to all cells whose bound reaches the last score it needs, and
  the result is certified: no other cell can hold a better row.
* That is done twice: for the positives, and for the windows of negatives that follow from the
  positives' scores. Every row is indexed, and results are those of comparing all rows.

Cells are packed into blocks of rows, and anchors into groups that visit a block together: one
matrix product. Blocks and visits meet by cell and block number, in a sorted stream in which a
block comes before its visits, so a task holds one block and one visit at a time.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtledger.llm.common import ship, stored

CODES = 16
#: Vectors the codebooks are fitted on, by smallest hash of their id. All rows are indexed.
SAMPLE = 20_000
FIT_ROUNDS = 10
BLOCK_ROWS = 32_768
GROUP = 256
#: Rows an anchor sees in the cells it visits first.
FIRST_ROWS = 4096
#: Anchors of a visit that are scored in one product.
TOGETHER = 32

LAST_ID = 2**63 - 1
#: Components beyond it could give products that no long holds.
MOST = 65_536.0

_STREAM = (
    "cell int, part int, kind int, nos binary, keys binary, labels binary, vectors binary, wins binary, needs binary"
)
_FOUND = "anchor bigint, win bigint, score bigint, key bigint, no bigint"
_BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def indexed_rows(embeddings: DataFrame) -> DataFrame:
    """``no, key, label, q`` of the rows that take part."""
    vector, label = embeddings["embedding"], embeddings["label"].cast("bigint")
    vec_id = embeddings["vec_id"].cast("bigint")
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST))
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return (
        embeddings.filter(label.isNotNull() & vector.isNotNull() & usable)
        .select(
            F.coalesce(vec_id, F.lit(LAST_ID)).alias("key"),
            moved.alias("label"),
            F.transform(vector, lambda x: F.floor(256 * x.cast("double")).cast("int")).alias("q"),
        )
        .withColumn("no", F.monotonically_increasing_id())
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of lists as a matrix; what a shorter row lacks counts as 0."""
    lengths = column.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(lengths), dims), np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = column.flatten().to_numpy()
    return out


class Codebooks:
    """Two codebooks of half vectors, and where the halves part."""

    def __init__(self, sample: np.ndarray):
        self.dims = sample.shape[1]
        self.cut = (self.dims + 1) // 2
        self.codes = [self._fit(half.astype(np.float64), k) for k, half in enumerate(self.halves(sample))]

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return rows[:, : self.cut], rows[:, self.cut :]

    @staticmethod
    def _fit(rows: np.ndarray, seed: int) -> np.ndarray:
        distinct = np.unique(rows, axis=0)
        rng = np.random.default_rng(seed)
        codes = distinct[rng.permutation(len(distinct))[:CODES]]
        for _ in range(FIT_ROUNDS):
            nearest, _ = _nearest(rows, codes)
            for k in range(len(codes)):
                own = rows[nearest == k]
                if len(own):
                    codes[k] = own.mean(axis=0)
        return codes

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Cells, and the distance of each half from its code."""
        found = [_nearest(half.astype(np.float64), c) for half, c in zip(self.halves(rows), self.codes)]
        (first, d1), (second, d2) = found
        return first * CODES + second, [d1, d2]


def _nearest(rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = (codes**2).sum(axis=1) - 2 * rows @ codes.T
    nearest = squares.argmin(axis=1)
    return nearest, np.sqrt(((rows - codes[nearest]) ** 2).sum(axis=1))


def _assigned(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = books.value.assign(_matrix(batch["q"], books.value.dims))
            arrays = [batch["no"], batch["key"], batch["label"], batch["q"], pa.array(cell.astype(np.int32))]
            arrays += [pa.array(d) for d in away]
            yield pa.RecordBatch.from_arrays(arrays, ["no", "key", "label", "q", "cell", "d1", "d2"])

    return run


def _raw(numbers: np.ndarray) -> bytes:
    return np.ascontiguousarray(numbers).tobytes()


def _stream_rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([(n, pa.int32()) for n in ("cell", "part", "kind")] + [
        (n, pa.binary()) for n in ("nos", "keys", "labels", "vectors", "wins", "needs")
    ])
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _packed(dims: int):
    """Rows that stand together by cell and part become one block, in order of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], None

        def block() -> pa.RecordBatch:
            nos, keys, labels, vectors = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(keys, kind="stable")
            parts = [_raw(a[order]) for a in (nos, keys, labels, vectors)]
            return _stream_rows([(*place, 0, *parts, b"", b"")])

        for batch in batches:
            cell, part = batch["cell"].to_numpy(), batch["part"].to_numpy()
            edges = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
            for low, high in zip([0, *edges], [*edges, len(cell)]):
                if low == high:
                    continue
                here = (int(cell[low]), int(part[low]))
                if here != place and held:
                    yield block()
                    held = []
                place = here
                own = batch.slice(low, high - low)
                held.append((*(own[c].to_numpy() for c in ("no", "key", "label")), _matrix(own["q"], dims)))
        if held:
            yield block()

    return run


class Cells:
    """What an anchor has to know of the index: codes, radii, and rows and blocks of each cell."""

    def __init__(self, books: Codebooks, stats: list):
        self.books, self.first_rows = books, FIRST_ROWS
        self.rows, self.parts = np.zeros(CODES * CODES, np.int64), np.zeros(CODES * CODES, np.int64)
        self.radii = [np.zeros(len(codes)) for codes in books.codes]
        for row in stats:
            self.rows[row.cell] = row.n
            self.parts[row.cell] = -(-row.n // BLOCK_ROWS)
            for half, code, far in ((0, row.cell // CODES, row.d1), (1, row.cell % CODES, row.d2)):
                self.radii[half][code] = max(self.radii[half][code], far)

    def heap(self, anchor: np.ndarray) -> Iterator[tuple[float, int]]:
        """Filled cells by descending bound: the multi-sequence heap over both halves."""
        order, bounds = [], []
        for half, codes, radii in zip(self.books.halves(anchor[None, :]), self.books.codes, self.radii):
            half = half[0].astype(np.float64)
            bound = codes @ half + np.sqrt((half**2).sum()) * radii
            order.append(np.argsort(-bound))
            bounds.append(bound[order[-1]])
        # Scores are whole numbers: half of one more than covers rounding.
        head = [(-(bounds[0][0] + bounds[1][0]), 0, 0)]
        while head:
            bound, i, j = heapq.heappop(head)
            cell = int(order[0][i]) * CODES + int(order[1][j])
            if self.rows[cell]:
                yield 0.5 - bound, cell
            if j + 1 < len(bounds[1]):
                heapq.heappush(head, (-(bounds[0][i] + bounds[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(bounds[0]):
                heapq.heappush(head, (-(bounds[0][i + 1] + bounds[1][0]), i + 1, 0))

    def visits(self, anchor: np.ndarray, need: float | None) -> Iterator[int]:
        """The first cells (``need`` None), or those after them that may still hold ``need``."""
        seen = 0
        for bound, cell in self.heap(anchor):
            first = seen < self.first_rows
            seen += int(self.rows[cell])
            if need is not None and bound < need:
                return
            if first == (need is None):
                yield cell
            elif need is None:
                return


def _visits(cells, rest: bool):
    """Groups of anchors and the blocks they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = cells.value
        for batch in batches:
            for low in range(0, batch.num_rows, GROUP):
                part = batch.slice(low, GROUP)
                nos, labels = part["no"].to_numpy(), part["label"].to_numpy()
                vectors = _matrix(part["q"], index.books.dims)
                wins = [np.array(w, np.int64) for w in part["wins"].to_pylist()]
                needs = [np.array(n, np.float64) for n in part["needs"].to_pylist()]
                width = max(map(len, wins), default=0)
                win, need = np.full((len(nos), width), -1, np.int64), np.full((len(nos), width), np.inf)
                for k, (w, n) in enumerate(zip(wins, needs)):
                    win[k, : len(w)], need[k, : len(w)] = w, n
                asked = defaultdict(list)
                for k in range(len(nos)):
                    if width and len(wins[k]):
                        for cell in index.visits(vectors[k], need[k].min() if rest else None):
                            asked[cell].append(k)
                rows = []
                for cell, who in asked.items():
                    columns = [_raw(a[who]) for a in (nos, labels, vectors, win, need)]
                    for block in range(int(index.parts[cell])):
                        rows.append((cell, block, 1, columns[0], b"", *columns[1:]))
                    if len(rows) > 200:
                        yield _stream_rows(rows)
                        rows = []
                yield _stream_rows(rows)

    return run


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, by the narrowest type that holds them."""
    lengths = [np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    most = lengths[0] * lengths[1] + 1
    if most < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _best(scores: np.ndarray, allowed: np.ndarray, keys: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row its ``top`` allowed columns by score, then key (columns are in key order)."""
    if scores.shape[1] > top:
        low = np.iinfo(np.int64).min
        masked = np.where(allowed, scores, low)
        kth = np.partition(masked, scores.shape[1] - top, axis=1)[:, scores.shape[1] - top]
        allowed = allowed & (scores >= kth[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < top], column[rank < top]


def _scored(dims: int, top: int, same: bool):
    """The best rows of every visited block. A window's rows are at most 90 % and at least 30 %
    of its score; the window -1 of positives takes any score."""

    def found(block, visit) -> Iterator[list[np.ndarray]]:
        nos, keys, labels, vectors = block
        who, kinds, anchors, wins, needs = visit
        for low in range(0, len(who), TOGETHER):
            part = slice(low, low + TOGETHER)
            scores = _products(anchors[part], vectors)
            alike = kinds[part][:, None] == labels
            if same:
                fits = alike & (who[part][:, None] != nos)
            else:
                fits = ~alike
            for k in range(wins.shape[1]):
                win, need = wins[part, k][:, None], needs[part, k][:, None]
                allowed = fits & (scores >= need)
                if not same:
                    allowed &= (win >= 0) & (100 * scores >= 30 * win) & (100 * scores <= 90 * win)
                row, column = _best(scores, allowed, keys, top)
                if len(row):
                    yield [who[part][row], win[row, 0], scores[row, column], keys[column], nos[column]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place = None, None
        names = ["anchor", "win", "score", "key", "no"]
        for batch in batches:
            for row in range(batch.num_rows):
                here = tuple(batch[c][row].as_py() for c in ("cell", "part"))
                raw = {c: batch[c][row].as_buffer() for c in ("nos", "keys", "labels", "vectors", "wins", "needs")}
                nos, labels = (np.frombuffer(raw[c], np.int64) for c in ("nos", "labels"))
                vectors = np.frombuffer(raw["vectors"], np.int32).reshape(len(nos), dims)
                if batch["kind"][row].as_py() == 0:
                    place, block = here, (nos, np.frombuffer(raw["keys"], np.int64), labels, vectors)
                elif here == place:
                    wins = np.frombuffer(raw["wins"], np.int64).reshape(len(nos), -1)
                    needs = np.frombuffer(raw["needs"], np.float64).reshape(len(nos), -1)
                    for columns in found(block, (nos, labels, vectors, wins, needs)):
                        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return run


class MultiIndex:
    """All rows in cells, and searches over them."""

    def __init__(self, rows: DataFrame):
        self.spark: SparkSession = rows.sparkSession
        self.rows = rows
        self.dims = rows.agg(F.max(F.size("q"))).first()[0] or 1
        sample = rows.select("q").orderBy(F.xxhash64("key"), "key", "q").limit(SAMPLE).toArrow()["q"]
        books = Codebooks(_matrix(sample.combine_chunks(), self.dims))
        context = self.spark.sparkContext
        shared = context.broadcast(books)
        kinds = "no bigint, key bigint, label bigint, q array<int>, cell int, d1 double, d2 double"
        assigned = stored(rows.mapInArrow(_assigned(shared), kinds), "cells")
        stats = assigned.groupBy("cell").agg(
            F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")
        )
        cells = Cells(books, stats.collect())  # at most CODES * CODES rows
        parts = F.array(*[F.lit(int(p)) for p in cells.parts])
        part = F.pmod(F.xxhash64("no"), F.element_at(parts, F.col("cell") + 1)).cast("int")
        self.blocks = stored(
            assigned.withColumn("part", part)
            .repartition("cell", "part")
            .sortWithinPartitions("cell", "part")
            .mapInArrow(_packed(self.dims), _STREAM),
            "blocks",
        )
        self.cells = context.broadcast(cells)

    def _visited(self, anchors: DataFrame, top: int, same: bool, rest: bool) -> DataFrame:
        """``anchors``: ``no, label, q, wins, needs``. What the cells visited hold of the best."""
        visits = anchors.select("no", "label", "q", "wins", "needs").mapInArrow(_visits(self.cells, rest), _STREAM)
        stream = self.blocks.unionByName(visits).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
        found = stream.mapInArrow(_scored(self.dims, top, same), _FOUND)
        return stored(_top(found, top), "found")

    def search(self, anchors: DataFrame, top: int, same: bool, least) -> DataFrame:
        """For every window the ``top`` rows: ``anchor, win, score, key, no, rank``.

        ``anchors``: ``no, label, q, wins``. ``least(win)``: the lowest score a window takes. The
        cells at the head of the heap come first, then all that may hold what is still needed.
        """
        open_ = F.transform("wins", lambda w: least(w))
        first = self._visited(anchors.withColumn("needs", open_), top, same, rest=False)
        last = first.filter(F.col("rank") == top).groupBy("anchor").agg(
            F.map_from_entries(F.collect_list(F.struct("win", F.col("score").cast("double")))).alias("last")
        )
        needs = F.transform(
            "wins", lambda w: F.coalesce(F.try_element_at("last", w), least(w))
        )
        waiting = anchors.join(last, anchors["no"] == last["anchor"], "left").withColumn("needs", needs)
        more = self._visited(stored(waiting.select("no", "label", "q", "wins", "needs"), "waiting"), top, same, rest=True)
        return _top(first.unionByName(more).drop("rank"), top)


def _top(found: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "key", "no")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def hard_negatives(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor do
    those with a component beyond 65536, whose products might not fit in a long. Where ``vec_id``
    is divisible by 7 the label moves on by one of ten. A component ``x`` counts as
    ``floor(256 * x)``; shorter vectors lack components, which count as 0. Anchors are the rows
    whose id is divisible by ``every``; their positives the best ``positives`` other rows of the
    label. For each positive the first ``negatives`` rows of other labels between 30 % and 90 % of
    its score follow, by score, then id. Null ids are no anchors and come last among ties. Repeated
    rows are rows of their own, also as each other's positives. A negative positive's window is
    empty. Empty tables give no rows; other columns are ignored.
    """
    spark = embeddings.sparkSession
    ship(spark)
    before = spark.conf.get(_BYTES_PER_BATCH, None)
    spark.conf.set(_BYTES_PER_BATCH, str(64 << 20))
    try:
        rows = stored(indexed_rows(embeddings), "vectors")
        if rows.isEmpty():
            return spark.createDataFrame(
                [],
                "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
            )
        index = MultiIndex(rows)
        anchors = stored(rows.filter((F.col("key") % every == 0) & (F.col("key") < LAST_ID)), "anchors")
        any_score = anchors.withColumn("wins", F.array(F.lit(-1).cast("bigint")))
        alike = stored(
            index.search(any_score, positives, True, lambda w: F.lit(float("-inf"))), "positives"
        )
        wins = alike.filter("score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("wins"))
        asking = stored(
            anchors.join(wins, anchors["no"] == wins["anchor"]).select("no", "label", "q", "wins"), "asking"
        )
        unlike = stored(
            index.search(asking, negatives, False, lambda w: F.ceil(w * 0.3 - 0.01).cast("double")), "negatives"
        )
    finally:
        if before is None:
            spark.conf.unset(_BYTES_PER_BATCH)
        else:
            spark.conf.set(_BYTES_PER_BATCH, before)
    own_id = F.nullif(F.col("key"), F.lit(LAST_ID))
    wanted = alike.select(
        "anchor", own_id.alias("positive_id"), F.col("score").alias("win"), F.col("score").alias("positive_score")
    )
    return (
        unlike.select("anchor", "win", "rank", own_id.alias("negative_id"), F.col("score").alias("negative_score"))
        .join(wanted, ["anchor", "win"])
        .join(anchors.select(F.col("no").alias("anchor"), F.col("key").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


#: The query of these negatives for the checking engine, by comparing each anchor with all rows.
ORACLE = """
WITH usable AS (
  SELECT row_number() OVER () AS no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.no AS anchor, a.vec_id AS anchor_id, b.no AS no, b.vec_id AS vec_id, a.label = b.label AS alike,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.no <> b.no),
positives AS (
  SELECT * FROM scores WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.no ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
  FROM positives p JOIN scores s ON p.anchor = s.anchor AND NOT s.alike
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT * FROM ranked WHERE rank <= 10
"""
