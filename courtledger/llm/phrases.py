"""Collocations: phrases that occur far more often than their parts would explain.

Words are counted, those that occur often enough get numbers, and every text becomes the
numbers of its words with a 0 for any other word and between pieces. Then, for phrases of two,
three and four words:

* Candidates are Apriori-safe: the phrase without its last and without its first word is
  frequent (as the level before has found), and so is the pair of these two, which overlap in
  the phrase. Every task counts the pairs it meets and deals them into buckets by hash, which
  are added up whole; a frequent pair is joined with the phrases of the level before by the
  numbers of its two parts. So a candidate is made once, however many tasks and places meet it.
* Candidates become the keys of double-array tries over word numbers, which are broadcast. In
  every task all places of some batches advance through the tries together, level by level;
  accepting states are counted by ``bincount``, and Spark sums the counts of the tasks. These are
  exact. The same walk marks the places where candidates begin, for the next level.

Words and candidates are split into shards of at most ``MOST_KEYS`` keys, one trie each. A task
has one trie in memory at a time. Texts are read once for all shards: a place is walked only in
those whose keys begin with its word, and counts are handed on for the keys that were met only.
So the work for a text does not grow with the number of shards; what does is the loading of each
trie, some milliseconds for every ``HELD_BYTES``.

Words of more than ``LONG_WORD`` bytes are looked up by their SHA-256.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtledger.llm.blocks import WHITE, first_of_text, groups, mix, texts_of, word_bounds
from courtledger.llm.common import batches_of, discard, ship, stored
from courtledger.llm.ordering import ordered
from courtledger.llm.tries import DoubleArray, number_keys

#: Keys of one trie, and so of one broadcast.
MOST_KEYS = 500_000
LONG_WORD = 64
#: Counts of accepting states that travel in one row.
CHUNK = 1 << 14
#: Distinct words, or a tenth of the pairs, that a task holds before it hands them on.
MOST_HELD = 200_000
#: Buckets of pairs: for so many words one, and so many for each shuffle partition.
BUCKET_WORDS, BUCKETS_EACH = 1 << 21, 4
SLICE = 1 << 20
#: Places that advance together, and bytes of text that are numbered together.
STEP = 1 << 18
#: Bytes of texts or numbers that a task is handed at once.
BATCH_BYTES = 4 << 20
#: Bytes of numbers that go through one trie after the other.
HELD_BYTES = 16 << 20

# What ends a piece, and what else ends a word.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"
_LOWER = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS + WORD_ENDS,
    b"abcdefghijklmnopqrstuvwxyz" + b" " * len(PIECE_ENDS + WORD_ENDS),
)
_PLAIN = np.frombuffer(_LOWER, np.uint8)
_ENDS_PIECE = np.zeros(256, dtype=np.int32)
_ENDS_PIECE[list(PIECE_ENDS)] = 1
_GAP = re.compile(b"[" + re.escape(PIECE_ENDS + WORD_ENDS) + b"]")

_ENCODED = "ids binary, marks binary"
_COUNTED = "chunk int, at binary, times binary"


def _slices(raw: bytes) -> Iterator[bytes]:
    """A text in parts of about a megabyte that end between words."""
    at = 0
    while at < len(raw):
        gap = _GAP.search(raw, at + SLICE) if len(raw) - at > SLICE else None
        end = gap.start() if gap else len(raw)
        yield raw[at:end]
        at = end


class _Words:
    """The words of some texts in plain bytes, and the distinct ones of each language."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, n_langs: int):
        plain = _PLAIN[data]
        starts, ends = word_bounds(plain, offsets)
        first = first_of_text(starts, offsets)
        self.starts, self.first = starts, first
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        cuts = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
        solid = np.ascontiguousarray(plain[~WHITE[plain]])
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(solid)])
        coded = words.dictionary_encode()
        pair = coded.indices.to_numpy().astype(np.int64) * n_langs + langs[self.text]
        room = len(coded.dictionary) * n_langs
        if room <= 8 * len(pair):
            met = np.zeros(room, dtype=bool)
            met[pair] = True
            #: Of each word its place among the distinct ones.
            self.which = (np.cumsum(met, dtype=np.int32) - 1)[pair]
            keys = np.flatnonzero(met)
        else:
            keys, self.which = np.unique(pair, return_inverse=True)
        self.words = coded.dictionary.take(pa.array(keys // n_langs))
        self.langs = keys % n_langs


def _kinds(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The languages of a batch, and the place of each row's language among them."""
    coded = column.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _parts(batch: pa.RecordBatch, kinds: np.ndarray) -> Iterator[tuple[list[bytes], list[int]]]:
    """Texts in groups of about a megabyte, long ones in slices, and each one's language."""
    parts, langs, size = [], [], 0
    for kind, text in zip(kinds, pc.cast(batch["text"], pa.binary())):
        for part in _slices(text.as_py()):
            parts.append(part)
            langs.append(kind)
            size += len(part)
            if size >= SLICE:
                yield parts, langs
                parts, langs, size = [], [], 0
    if parts:
        yield parts, langs


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language and how often; a null word stands for all of them."""
    names = ["lang", "word", "n"]
    held: list[pa.Table] = []

    def added(by: list[str]) -> pa.Table:
        sums = pa.concat_tables(held).group_by(by, use_threads=False).aggregate([("n", "sum")])
        return sums.select([*by, "n_sum"]).rename_columns([*by, "n"])

    def rows() -> pa.RecordBatch:
        totals = added(["lang"])
        totals = totals.add_column(1, "word", pa.nulls(len(totals), pa.binary()))
        both = pa.concat_tables([*held, totals]).combine_chunks()
        held.clear()
        return pa.RecordBatch.from_arrays([both[c].chunk(0) for c in names], names)

    for batch in batches:
        kinds, of_row = _kinds(batch["lang"])
        for parts, langs in _parts(batch, of_row):
            offsets = np.append(0, np.cumsum([len(part) for part in parts]))
            found = _Words(np.frombuffer(b"".join(parts), np.uint8), offsets, np.array(langs), len(kinds))
            counts = np.bincount(found.which, minlength=len(found.words))
            own = kinds.take(pa.array(found.langs))
            held.append(pa.Table.from_arrays([own, found.words, pa.array(counts)], names))
            if sum(map(len, held)) > 2 * MOST_HELD:
                held[:] = [added(["lang", "word"])]
                if len(held[0]) > MOST_HELD:
                    yield rows()
    if held:
        held[:] = [added(["lang", "word"])]
        yield rows()


def _lookup_key() -> Column:
    """What of a word is compared; 0xFE and 0xFF are no bytes of UTF-8."""
    digest = F.concat(F.lit(bytes([0xFE])), F.unhex(F.sha2("word", 256)))
    own = F.when(F.octet_length("word") > LONG_WORD, digest).otherwise(F.col("word"))
    return F.concat(F.col("lang").cast("binary"), F.lit(bytes([0xFF])), own)


def _shards(table: DataFrame, size: int) -> Iterator[DataFrame]:
    """The rows of numbers 1 to ``size`` in shares that fit into one trie."""
    for low in range(0, size, MOST_KEYS):
        yield table.filter(F.col("no").between(low + 1, low + MOST_KEYS))


def _value(shared: Broadcast, keep: bool):
    """What is broadcast; the worker keeps it for its next tasks only if told so."""
    value = shared.value
    if not keep:
        vars(shared).pop("_value", None)
    return value


def _together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches of about ``most`` bytes together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _trie(rows: pa.Table, width: int | None = None) -> DoubleArray:
    """Keys of one shard. With ``width`` they are lists of numbers of so many bytes."""
    values = rows["no"].to_numpy().astype(np.int32)
    if width is None:
        return DoubleArray(*texts_of(rows["key"]), values)
    ids = rows["ids"].combine_chunks()
    ids = ids.flatten().to_numpy().reshape(len(values), -1)
    return DoubleArray(*number_keys(ids, width), values)


def _int32(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of binary rows, and where each row begins."""
    raw, offsets = texts_of(column)
    return np.frombuffer(raw, np.int32), offsets // 4


def _binary(numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(numbers, np.int32).tobytes()
    ends = pa.py_buffer((offsets * 4).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(raw)])


def _fill_in(numbers: np.ndarray, trie: DoubleArray, words: _Words, roots: np.ndarray) -> None:
    """Numbers of the distinct words that the trie has; ``roots`` of the languages, -1 for none."""
    flat, offsets = texts_of(words.words)
    own = roots[words.langs]
    found = trie.segments(flat, offsets[:-1], offsets[1:], own)
    for k in np.flatnonzero(np.diff(offsets) > LONG_WORD):
        if own[k] >= 0:
            digest = hashlib.sha256(flat[offsets[k] : offsets[k + 1]].tobytes()).digest()
            state = trie.walk(b"\xfe" + digest, int(own[k]))
            found[k] = trie.value[state] if state >= 0 else 0
    np.copyto(numbers, found, where=found > 0)


def _spaced(words: _Words, numbers: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of some texts, zeros between pieces and after each text, and their offsets."""
    starts, first = words.starts, words.first
    piece = np.cumsum(_ENDS_PIECE[data], dtype=np.int32)
    piece = piece[starts] + words.text if len(starts) else piece[:0]
    gap = np.zeros(len(starts), np.int64)
    gap[1:] = piece[1:] != piece[:-1]
    # One zero before each piece but the first of a text, one after each text.
    place = np.arange(len(starts)) + np.cumsum(gap)
    out = np.zeros(len(starts) + int(gap.sum()) + 1, np.int32)
    out[place] = numbers[words.which]
    cuts = np.append(place, len(out))[first]
    cuts[0], cuts[-1] = 0, len(out)
    return out, cuts


def _numbered(tries: list[Broadcast]):
    """Fills in the numbers of the words, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch["text"])
            names, langs = _kinds(batch["lang"])
            spans = []
            for low, high in groups(offsets, 4 * STEP):
                part = data[offsets[low] : offsets[high]]
                words = _Words(part, offsets[low : high + 1] - offsets[low], langs[low:high], len(names))
                spans.append((part, words, np.zeros(len(words.words), np.int32)))
            for shared in tries:
                trie = _value(shared, len(tries) == 1)
                roots = np.array([trie.walk(str(lang).encode() + b"\xff") for lang in names], np.int64)
                for _, words, numbers in spans:
                    _fill_in(numbers, trie, words, roots)
            for part, words, numbers in spans:
                ids, cuts = _spaced(words, numbers, part)
                # Of several zeros in a row one is enough.
                keep = np.ones(len(ids), dtype=bool)
                keep[1:] = (ids[1:] > 0) | (ids[:-1] > 0)
                upto = np.append(0, np.cumsum(keep))
                column = _binary(ids[keep], upto[cuts])
                yield pa.RecordBatch.from_arrays([column, column], ["ids", "marks"])

    return run


def _open_places(marks: np.ndarray) -> Iterator[np.ndarray]:
    """Where a frequent phrase of the level before begins, and at the next word another one."""
    for low in range(0, len(marks) - 1, STEP):
        part = marks[low : low + STEP + 1] > 0
        yield np.flatnonzero(part[:-1] & part[1:]) + low


def _identity(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A phrase is told by the numbers of its two halves that overlap, both below 2^31."""
    return (marks[at].astype(np.int64) << 32) | marks[at + 1]


def _packed(pairs: np.ndarray, times: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Ascending pairs between two cuts each, and how often they are met, as one value: all first
    bytes together, then all second bytes, and so on, of which many are 0."""
    numbers = np.empty((len(pairs), 3), np.int32)
    left = (pairs >> 32).astype(np.int32)
    numbers[:, 0] = np.diff(left, prepend=np.int32(0))
    numbers[cuts[:-1], 0] = left[cuts[:-1]]
    numbers[:, 1], numbers[:, 2] = pairs, times
    raw = numbers.view(np.uint8)
    return pa.array([np.ascontiguousarray(raw[a:b].T).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())


def _unpacked(value: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(value.as_buffer(), np.uint8).reshape(12, -1)
    numbers = np.ascontiguousarray(raw.T).view(np.int32)
    return (numbers[:, 0].cumsum(dtype=np.int64) << 32) | numbers[:, 1], numbers[:, 2]


def _pairs(buckets: int):
    """The pairs of halves of a task's phrases and how often each is met, in one row for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            every = np.concatenate([np.empty(0, np.int64), *held])
            held.clear()
            every.sort()
            begins = np.flatnonzero(np.append(True, every[1:] != every[:-1])[: len(every)])
            found, times = every[begins], np.diff(np.append(begins, len(every))).astype(np.int32)
            del every, begins
            bucket = (mix(found.view(np.uint64)) % np.uint64(buckets)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            found, times, bucket = found[order], times[order], bucket[order]
            del order
            present, at = np.unique(bucket, return_index=True)
            packed = _packed(found, times, np.append(at, len(found)))
            return pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), packed], ["bucket", "pairs"])

        for batch in batches:
            marks, _ = _int32(batch["marks"])
            for at in _open_places(marks):
                held.append(_identity(marks, at))
                if sum(map(len, held)) > 10 * MOST_HELD:
                    yield rows()
        yield rows()

    return run


def _paired(least: int):
    """Pairs that reach ``least`` when the counts of all tasks are added; buckets stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, pairs, times = None, [], []

        def rows() -> pa.RecordBatch:
            every, n = np.concatenate(pairs), np.concatenate(times)
            order = np.argsort(every)
            every = every[order]
            begins = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
            often = np.add.reduceat(n[order], begins, dtype=np.int64) >= least
            return pa.RecordBatch.from_arrays([pa.array(every[begins[often]])], ["pair"])

        for batch in batches:
            for number, value in zip(batch["bucket"].to_pylist(), batch["pairs"]):
                if number != bucket:
                    if pairs:
                        yield rows()
                    bucket, pairs, times = number, [], []
                own, n = _unpacked(value)
                pairs.append(own)
                times.append(n)
        if pairs:
            yield rows()

    return run


def _candidates(pairs: DataFrame, former: DataFrame, size: int) -> DataFrame:
    """``ids`` of the phrase of ``size`` words that each ``pair`` stands for.

    ``former``: ``ids, no`` of the frequent phrases of one word less.
    """
    halves = pairs.select(
        F.shiftright("pair", 32).alias("left"), F.col("pair").bitwiseAND(F.lit(2**32 - 1)).alias("right")
    )
    if size == 2:  # words are their own numbers
        return halves.select(F.array(F.col("left").cast("int"), F.col("right").cast("int")).alias("ids"))
    begun = former.select(F.col("no").alias("left"), F.col("ids").alias("begin"))
    ended = former.select(F.col("no").alias("right"), F.slice("ids", size - 1, 1).alias("end"))
    return halves.join(begun, "left").join(ended, "right").select(F.concat("begin", "end").alias("ids"))


def _by_shard(first: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of the shards that may hold a key for them, and each shard's range of these.

    ``first``: their words; keys of shard ``k`` begin with the words ``lows[k]`` to ``highs[k]``,
    both included, so that neighbouring shards may share one.
    """
    begin, end = np.searchsorted(highs, first), np.searchsorted(lows, first, "right")
    order = np.argsort((begin + end).astype(np.uint16), kind="stable")
    shards = np.arange(len(lows))
    return order, np.searchsorted(end[order], shards, "right"), np.searchsorted(begin[order], shards, "right")


def _chunked(counts: np.ndarray, low: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """The counts of the keys met, a row for each chunk of numbers; ``low``: the number of the first, from 0."""
    hit = np.flatnonzero(counts)
    number, times = hit + low, counts[hit].astype(np.int32)
    present, at = np.unique(number // CHUNK, return_index=True)
    cuts, place = np.append(at, len(hit)), (number % CHUNK).astype(np.uint16)
    raw = [pa.array([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()) for x in (place, times)]
    return pa.array(present.astype(np.int32)), *raw


def _walked(size: int, width: int, tries: list[Broadcast], lows: np.ndarray, highs: np.ndarray, last: bool):
    """How often the walk from any place ends in each key, in chunks of keys, and, but for the
    ``last`` level, the texts with marks where a key begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _together(batches, HELD_BYTES):
            # Every text ends with a 0, so no phrase goes from one to the next.
            ids, marks = (np.concatenate([_int32(batch[c])[0] for batch in held]) for c in ("ids", "marks"))
            texts = [_int32(batch["ids"])[1] for batch in held]
            held.clear()
            places = np.concatenate([np.empty(0, np.int64), *_open_places(marks)])
            del marks
            begins, ends = np.zeros(1, np.int64), np.array([len(places)])
            if len(tries) > 1:
                order, begins, ends = _by_shard(ids[places], lows, highs)
                places = places[order]
            more = np.zeros(len(ids), np.int32)
            for k in np.flatnonzero(begins < ends):
                shard = _value(tries[k], len(tries) == 1)
                counts = np.zeros(MOST_KEYS, np.int64)
                for a in range(begins[k], ends[k], STEP):
                    at = places[a : min(a + STEP, ends[k])]
                    found = shard.sequences(ids, at, size, width)
                    hit = found > 0
                    more[at[hit]] = found[hit]
                    part = np.bincount(found[hit] - (k * MOST_KEYS + 1))
                    counts[: len(part)] += part
                own = _chunked(counts, int(k) * MOST_KEYS)
                none = [] if last else [pa.nulls(len(own[0]), pa.binary())] * 2
                yield _rows([*none, *own], last)
            begin = 0
            for cuts in [] if last else texts:
                own = slice(begin, begin + cuts[-1])
                none = [pa.nulls(len(cuts) - 1, kind) for kind in (pa.int32(), pa.binary(), pa.binary())]
                yield _rows([_binary(ids[own], cuts), _binary(more[own], cuts), *none], last)
                begin = own.stop

    return run


def _rows(arrays: list[pa.Array], last: bool) -> pa.RecordBatch:
    names = ["ids", "marks", "chunk", "at", "times"]
    return pa.RecordBatch.from_arrays(arrays, names[2:] if last else names)


def _summed(least: int):
    """Keys that reach ``least`` when the counts of all tasks are added; chunks stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = None, np.zeros(CHUNK, np.int64)

        def rows() -> pa.RecordBatch:
            hit = np.flatnonzero(total >= least)
            numbers = hit + (1 + chunk * CHUNK)
            return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(total[hit])], ["no", "n"])

        for batch in batches:
            for number, at, times in zip(batch["chunk"].to_pylist(), batch["at"], batch["times"]):
                if number != chunk:
                    if chunk is not None:
                        yield rows()
                    chunk, total = number, np.zeros(CHUNK, np.int64)
                total[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(times.as_buffer(), np.int32)
        if chunk is not None:
            yield rows()

    return run


def _tries(table: DataFrame, size: int, width: int | None) -> tuple[list[Broadcast], np.ndarray, np.ndarray]:
    """A trie for each shard of ``table``, and with ``width`` the least and the greatest first
    number of its keys. Only one of them at a time is the driver's to build."""
    context, tries, bounds = table.sparkSession.sparkContext, [], []
    for shard in _shards(table, size):
        rows = shard.toArrow()
        if width is not None:
            first = pc.list_element(rows["ids"], 0).to_numpy()
            bounds.append((first.min(), first.max()))
        tries.append(context.broadcast(_trie(rows, width)))
    lows, highs = np.array(bounds, np.int64).reshape(-1, 2).T
    return tries, lows, highs


def _numbers(table: DataFrame, label: str) -> DataFrame:
    """What ``ordered`` has numbered, stored with numbers from 1 on, by which files can be skipped."""
    rows = stored(table.withColumn("no", F.col("no") + 1), label)
    discard(table)
    return rows


def _encoded(texts: DataFrame, words: DataFrame, size: int) -> DataFrame:
    tries, _, _ = _tries(words.select("no", _lookup_key().alias("key")), size, None)
    rows = texts.mapInArrow(_numbered(tries), _ENCODED)
    state = stored(rows.filter(F.octet_length("ids") > 8), "numbered")
    for trie in tries:
        trie.destroy()
    return state


def _frequent(
    texts: DataFrame, former: DataFrame, size: int, width: int, least: int, buckets: int, last: bool
) -> tuple[DataFrame | None, DataFrame | None]:
    """``ids, n, no`` of the phrases of ``size`` words that occur ``least`` times, None if there are
    none, and, but for the ``last`` level, the texts with marks where these begin.

    ``former``: the phrases of one word less."""
    counted = texts.select("marks").mapInArrow(_pairs(buckets), "bucket int, pairs binary")
    counted = counted.repartition("bucket").sortWithinPartitions("bucket")
    pairs = stored(counted.mapInArrow(_paired(least), "pair bigint"), "pairs")
    table = ordered(_candidates(pairs, former, size), [F.col("ids")], "candidates", place="no")
    table = _numbers(table, "keys")
    keys = table.count()
    discard(pairs)
    if not keys:
        discard(table)
        return None, None
    tries, lows, highs = _tries(table, keys, width)
    schema = _COUNTED if last else f"{_ENCODED}, {_COUNTED}"
    walked = stored(texts.mapInArrow(_walked(size, width, tries, lows, highs, last), schema), "marked")
    for trie in tries:
        trie.destroy()
    counts = walked.filter("chunk IS NOT NULL").select("chunk", "at", "times")
    summed = counts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_summed(least), "no bigint, n bigint")
    result = stored(table.join(summed, "no").select("ids", "n", "no"), f"phrases-{size}")
    discard(table)
    if last:
        discard(walked)
        return result, None
    return result, walked.filter("chunk IS NULL").select("ids", "marks")


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, covered: int = 80, scale: int = 2_000_000
) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of 2 to ``longest`` words that stay.

    Texts in lower case (A-Z only) are split into pieces at ``. , ; : ! ?`` and line ends, and
    those into words at blanks and tabs. Per language (null: ``und``) a phrase counts all its
    occurrences within pieces; those with ``a >= least`` are candidates. Cut after its first
    words, a candidate has the counts ``l`` and ``r`` of its two parts and the score
    ``floor(scale * a / (l + r))``; its lowest score counts, of equal ones that of the shortest
    first part. Candidates inside a longer one that occurs at least ``covered`` times for 100 of
    theirs are dropped. ``n``: all words of the language.

    Null and empty texts have no words; other columns than ``lang`` and ``text`` are ignored,
    repeated rows count each time; a table without frequent words gives no rows. Products are
    taken as decimals of 38 digits.
    """
    ship(docs.sparkSession)
    texts = docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    # What is returned reads stored tables only and hands nothing to Python.
    with batches_of(docs.sparkSession, BATCH_BYTES):
        found, known, words, totals = _mined(texts, longest, least)
    return _judged(found, known, words, totals, covered, scale)


def _mined(texts: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Frequent phrases, the frequent words as such phrases, these words, words of each language."""
    counted = texts.mapInArrow(_word_counts, "lang string, word binary, n bigint")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = stored(counted.filter((F.col("n") >= least) | F.col("word").isNull()), "word-counts")
    totals = counted.filter("word IS NULL").select("lang", F.col("n").alias("total"))
    words = ordered(counted.filter("word IS NOT NULL"), [F.col("lang"), F.col("word")], "words", place="no")
    words = _numbers(words, "word-numbers")
    n_words = words.count()
    width = max(1, (n_words.bit_length() + 7) // 8)
    known = words.select(F.array(F.col("no").cast("int")).alias("ids"), "n", "no")
    levels = []
    if n_words:
        state, phrases = _encoded(texts, words, n_words), known
        # Each pair lies in one bucket, which is one task's.
        every = totals.agg(F.sum("total")).first()[0]
        partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(max(every // BUCKET_WORDS, BUCKETS_EACH * partitions), 1 << 16)
        for size in range(2, longest + 1):
            former = state
            phrases, state = _frequent(former, phrases, size, width, least, buckets, size == longest)
            discard(former)
            if phrases is None:
                break
            levels.append(phrases.select("ids", "n"))
        if state is not None:
            discard(state)
    if not levels:
        levels = [known.select("ids", "n").limit(0)]
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found, known.select("ids", "n"), words, totals


def _judged(
    found: DataFrame, known: DataFrame, words: DataFrame, totals: DataFrame, covered: int, scale: int
) -> DataFrame:
    size = F.size("ids")
    counts = found.unionByName(known)
    cuts = (
        found.select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
        .select(
            "ids",
            "a",
            "k",
            F.slice("ids", 1, F.col("k")).alias("first"),
            F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("rest"),
        )
        .join(counts.select(F.col("ids").alias("first"), F.col("n").alias("l")), "first")
        .join(counts.select(F.col("ids").alias("rest"), F.col("n").alias("r")), "rest")
    )
    score = F.expr(
        f"CAST(a AS decimal(19,0)) * CAST({scale} AS decimal(19,0)) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))"
    )
    lowest = cuts.groupBy("ids", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low"))
    inner = found.filter(size > 2).select(
        "n",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), size - 1),
                    lambda m: F.transform(
                        F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("ids", i, m)
                    ),
                )
            )
        ).alias("ids"),
    )
    longer = inner.groupBy("ids").agg(F.max("n").alias("most"))
    wide = "decimal(22,0)"
    hidden = 100 * F.col("most").cast(wide) >= covered * F.col("a").cast(wide)
    kept = lowest.join(longer, "ids", "left").filter(~F.coalesce(hidden, F.lit(False)))
    spelled = (
        kept.select("ids", F.posexplode("ids").alias("at", "no"))
        .join(words.select(F.col("no").cast("int").alias("no"), "lang", F.col("word").cast("string").alias("word")), "no")
        .groupBy("ids", "lang")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
        .select("ids", "lang", F.array_join("parts.word", " ").alias("phrase"))
    )
    return (
        kept.join(spelled, "ids")
        .join(totals, "lang")
        .select(
            "lang",
            "phrase",
            "a",
            F.col("low.l").alias("l"),
            F.col("low.r").alias("r"),
            F.col("total").alias("n"),
            F.col("low.score").cast("bigint").alias("score"),
        )
    )


#: The query of these phrases for the checking engine, from plain counts of all phrases.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k)),
f AS (SELECT lang, phrase, k, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, k AS size, n AS a FROM f WHERE k > 1 AND n >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r, 2000000::HUGEINT * c.a // (x.n + y.n) AS score
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.size], ' ')),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda m:
    list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase
  FROM candidates),
longer AS (SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN longer g USING (lang, phrase)
  WHERE g.most IS NULL OR 100::HUGEINT * g.most < 80::HUGEINT * l.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, totals.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
