"""Work on whole Arrow batches of texts as one byte array: words, segments and their hashes.

Everything here is plain numpy on the bytes that Spark hands to a task. Arrays that need
eight bytes for each byte of text are made for at most ``SPAN`` bytes at a time, so a very
long text costs a few times its own size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPAN = 1 << 20
#: Texts are worked on in groups of about so many bytes (one text at least).
GROUP_BYTES = 4 << 20

_rng = np.random.default_rng(20_240_611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


_tables: dict[int, np.ndarray] = {}


def powers(base: int, most: int = SPAN) -> np.ndarray:
    """Powers of ``base`` modulo 2^64 up to ``most`` at least."""
    if base not in _tables or len(_tables[base]) <= most:
        steps = np.full(most + 1, np.uint64(base))
        steps[0] = 1
        _tables[base] = np.multiply.accumulate(steps)
    return _tables[base]


@cache
def _place_keys() -> np.ndarray:
    """An odd pseudorandom number for each place in a range of up to ``SPAN`` bytes."""
    keys = np.random.default_rng(19_910_705).integers(0, 2**63, SPAN, dtype=np.uint64)
    return keys * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run of bytes that are no white space; no run crosses a text."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    solid = ~WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return starts, ends


def segment_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """64-bit hashes of byte ranges, ascending and apart from each other; equal bytes, equal hash.

    A range has the sum of a pseudorandom number for each of its bytes and the byte's place in it.
    Powers of one base in place of those numbers would not do: modulo 2^64 they let words built
    like Thue-Morse sequences fall together whatever the base. ``lower`` takes A-Z as a-z.
    """
    table, keys = _BYTE_LOWER if lower else _BYTE, _place_keys()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        end = int(np.searchsorted(ends, base + SPAN, "right"))
        if end <= at:  # one range longer than SPAN
            piece = data[base : ends[at]]
            if lower:
                piece = np.where((piece >= 65) & (piece <= 90), piece + 32, piece).astype(np.uint8)
            out[at] = int.from_bytes(blake2b(piece.tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        s, e = starts[at:end] - base, ends[at:end] - base
        n = int(e[-1])
        place = np.arange(n) - np.repeat(s, np.diff(np.append(s, n)))
        numbers = table[data[base : base + n]] * keys[place]
        numbers ^= numbers >> np.uint64(32)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(numbers, out=sums[1:])
        out[at:end] = mix(sums[e] - sums[s] + (e - s).astype(np.uint64))
        at = end
    return out


def first_of_text(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index into ascending ``places`` at which each text begins (one more entry than texts)."""
    return np.searchsorted(places, offsets, "left")


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on, as far as there are so many."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n])
    return out


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, size: int
) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``size`` words.

    A-Z count as a-z. A text with fewer words has its whole sequence as one shingle; a text
    without words has none.
    """
    for low, high in groups(offsets):
        base = offsets[low]
        part, cuts = data[base : offsets[high]], offsets[low : high + 1] - base
        starts, ends = word_bounds(part, cuts)
        words = segment_hashes(part, starts, ends, lower=True)
        every = shingle_hashes(words, size)
        first = first_of_text(starts, cuts)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= size:
                yield np.unique(every[a : b - size + 1])
            elif b > a:  # the number of words keeps short sequences apart from each other
                yield shingle_hashes(words[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield np.empty(0, np.uint64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
