"""Token ids on disk as wavelet matrices: one compressed, searchable file section per shard.

A shard holds the ids of many whole documents. Its ids are stored bit-plane by bit-plane,
highest bit first; each plane lists the bits in an order in which the zeros of the plane
before come first. With counts of ones every 512 bits that is enough to read the token at a
place, to count a token in any range and to find its k-th occurrence, each in one step per
plane, without decoding the rest: planes are compressed in blocks which are opened only when
needed. Shards are rows of a Parquet table, so Spark commits and moves them as it does all
other data; the bytes of a shard are complete in themselves.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtledger.llm.common import keyed, ship
from courtledger.llm.subwords import ended_ids

MAGIC = b"WMTX0001"
#: Bits between stored counts, and bits of a plane that are compressed together.
STEP, BLOCK = 512, 1 << 18
SHARD_TOKENS = 1 << 21

_SHARDS = "part int, seq int, n_docs bigint, n_tokens bigint, shard binary"
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)


def _section(parts: list[bytes], data: bytes) -> None:
    packed = zstandard.ZstdCompressor(level=1).compress(data)
    parts.append(struct.pack("<I", len(packed)) + packed)


def encode_shard(ids: np.ndarray, lengths: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray) -> bytes:
    """The bytes of a shard: ids of all documents in a row, and which documents they are."""
    ids = np.asarray(ids, np.uint32)
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    parts = [MAGIC + struct.pack("<QQI", len(ids), len(lengths), planes)]
    for column in (np.asarray(doc_ids, "<i8"), np.asarray(nulls, "<u1"), np.asarray(lengths, "<i8")):
        _section(parts, column.tobytes())
    order = ids
    for plane in reversed(range(planes)):
        ones = (order >> np.uint32(plane) & np.uint32(1)).astype(bool)
        packed = np.packbits(ones, bitorder="little")
        packed = np.append(packed, np.zeros(-len(packed) % (STEP // 8), np.uint8))
        steps = _ONES[packed].reshape(-1, STEP // 8).sum(1, dtype=np.int64)
        counts = np.zeros(len(steps) + 1, "<u4")
        np.cumsum(steps, out=counts[1:])
        parts.append(struct.pack("<Q", len(ids) - int(counts[-1])))
        _section(parts, counts.tobytes())
        size = BLOCK // 8
        for at in range(0, len(packed), size):
            _section(parts, packed[at : at + size].tobytes())
        order = np.concatenate([order[~ones], order[ones]])
    return b"".join(parts)


class Shard:
    """A shard's bytes, opened: documents, and access, counting and search of tokens."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        self.raw = memoryview(raw)
        self.n, docs, self.planes = struct.unpack_from("<QQI", raw, 8)
        at = 8 + struct.calcsize("<QQI")
        columns = []
        for kind in ("<i8", "<u1", "<i8"):
            data, at = self._open(at)
            columns.append(np.frombuffer(data, kind, docs))
        self.doc_ids, self.nulls, self.lengths = columns
        self.zeros, self.counts, self.blocks = [], [], []
        self.opened: dict[tuple[int, int], np.ndarray] = {}
        plane_bytes = -(-self.n // STEP) * (STEP // 8)
        for _ in range(self.planes):
            self.zeros.append(struct.unpack_from("<Q", raw, at)[0])
            counts, at = self._open(at + 8)
            self.counts.append(np.frombuffer(counts, "<u4"))
            places = []
            for _ in range(0, plane_bytes, BLOCK // 8):
                places.append(at)
                at += 4 + struct.unpack_from("<I", raw, at)[0]
            self.blocks.append(places)

    def _open(self, at: int) -> tuple[bytes, int]:
        (size,) = struct.unpack_from("<I", self.raw, at)
        data = zstandard.ZstdDecompressor().decompress(self.raw[at + 4 : at + 4 + size])
        return data, at + 4 + size

    def _block(self, level: int, block: int) -> np.ndarray:
        if (level, block) not in self.opened:
            data, _ = self._open(self.blocks[level][block])
            self.opened[level, block] = np.frombuffer(data, np.uint8)
        return self.opened[level, block]

    def _bit(self, level: int, place: int) -> int:
        data = self._block(level, place // BLOCK)
        place %= BLOCK
        return int(data[place >> 3] >> (place & 7) & 1)

    def _rank1(self, level: int, place: int) -> int:
        """Ones among the first ``place`` bits of a plane."""
        ones = int(self.counts[level][place // STEP])
        left = place % STEP
        if left:
            begin = (place - left) % BLOCK // 8
            data = self._block(level, place // BLOCK)[begin : begin + (left + 7) // 8]
            ones += int(_ONES[data].sum())
            if left % 8:
                ones -= int(_ONES[data[-1] >> (left % 8)])
        return ones

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        counts = self.counts[level].astype(np.int64)
        if not bit:
            counts = np.arange(len(counts), dtype=np.int64) * STEP - counts
        step = int(np.searchsorted(counts, k, "right")) - 1
        begin = step * STEP
        data = self._block(level, begin // BLOCK)[begin % BLOCK // 8 :][: STEP // 8]
        bits = np.unpackbits(data, bitorder="little")
        return begin + int(np.flatnonzero(bits == bit)[k - counts[step]])

    def access(self, place: int) -> int:
        """The token at ``place``."""
        if not 0 <= place < self.n:
            raise IndexError(place)
        token = 0
        for level in range(self.planes):
            bit = self._bit(level, place)
            ones = self._rank1(level, place)
            place = self.zeros[level] + ones if bit else place - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> self.planes:
            return 0, 0
        for level in range(self.planes):
            below, above = self._rank1(level, low), self._rank1(level, high)
            if token >> (self.planes - 1 - level) & 1:
                low, high = self.zeros[level] + below, self.zeros[level] + above
            else:
                low, high = low - below, high - above
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` at places from ``low`` up to, without, ``high``.

        Places outside the shard hold nothing; so does a range that ends before it begins.
        """
        high = self.n if high is None else high
        low, high = (min(max(place, 0), self.n) for place in (low, high))
        if high <= low:
            return 0
        first, last = self._range(token, low, high)
        return last - first

    def locate(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``token``."""
        first, last = self._range(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        place = first + k
        for level in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - level) & 1
            place = self._select(level, bit, place - self.zeros[level] if bit else place)
        return place

    def decode(self) -> np.ndarray:
        """All tokens, undoing one plane after the other."""
        ids = np.zeros(self.n, np.uint32)
        for level in reversed(range(self.planes)):
            data = b"".join(self._open(at)[0] for at in self.blocks[level])
            ones = np.unpackbits(np.frombuffer(data, np.uint8), count=self.n, bitorder="little").astype(bool)
            before = np.empty_like(ids)
            before[~ones] = ids[: self.zeros[level]]
            before[ones] = ids[self.zeros[level] :] | np.uint32(1 << (self.planes - 1 - level))
            ids = before
        return ids


def _write(vocabulary_path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, docs, held = [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) for x in ids], np.int64)
            nulls = np.array([d is None for d in docs], np.uint8)
            numbers = np.array([d or 0 for d in docs], np.int64)
            raw = encode_shard(np.concatenate(ids), lengths, numbers, nulls)
            row = [[part], [seq], [len(docs)], [int(lengths.sum())], [raw]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = ["part", "seq", "n_docs", "n_tokens", "shard"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for doc, own in zip(batch["doc_id"].to_pylist(), ended_ids(batch["text"], vocabulary_path, end_id)):
                ids.append(own)
                docs.append(doc)
                held += len(own)
                if held >= shard_tokens:
                    yield flush()
                    ids, docs, held, seq = [], [], 0, seq + 1
        if docs:
            yield flush()

    return run


def write_shards(
    docs: DataFrame, path: str, vocabulary_path: str, end_id: int, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Writes the ids of every text, each followed by ``end_id``, in ascending order of ids.

    A null text counts as empty, a null id comes first, rows that repeat an id stand one
    after the other. A shard takes whole documents until it holds ``shard_tokens`` ids. An
    empty table gives no shard.
    """
    rows = keyed(docs).repartitionByRange("rid", "rth").sortWithinPartitions("rid", "rth")
    rows.select("doc_id", "text").mapInArrow(
        _write(vocabulary_path, end_id, shard_tokens), _SHARDS
    ).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            shard = Shard(batch["shard"][k].as_py())
            ids = shard.decode().astype("<u4")
            stops = np.cumsum(shard.lengths)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip((stops - shard.lengths).tolist(), stops.tolist())]
            n = len(stops)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, batch["part"][k].as_py(), np.int32)),
                    pa.array(np.full(n, batch["seq"][k].as_py(), np.int32)),
                    pa.array(shard.doc_ids, pa.int64(), mask=shard.nulls.astype(bool)),
                    pa.array(stops - shard.lengths),
                    pa.array(shard.lengths),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "seq", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shards.

    ``start`` counts the ids of all documents before it. Shards are numbered within the task
    that wrote them, so sums run over the shards of a task, and then over the tasks.
    """
    ship(spark)
    shards = spark.read.schema(_SHARDS).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens")
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    bases = (
        sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(parts, "part")
        .select("part", "seq", (F.col("base") + F.col("within")).alias("base"))
    )
    docs = shards.select("part", "seq", "shard").mapInArrow(
        _read,
        "part int, seq int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return docs.join(bases, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
