"""Removal of byte strings that occur twice, by suffix arrays of what can match at all.

1. Anchors. In every window of ``length`` bytes the substring of ``GRAM`` bytes with the
   smallest hash (leftmost of equal ones) is its anchor. Equal windows have equal anchors at
   equal places, so only windows of anchors that occur twice can repeat: the rest of the
   corpus is never sorted. The windows of one anchor are neighbours and form a slice.
2. Equal slices are counted before any text moves. Distinct slices that share an anchor are
   fetched from the texts and sorted together.
3. Suffix arrays, by two-stage sorting: of the suffixes of all slices in a group only those
   smaller than their successors are sorted directly; the others follow from them by one
   ascending scan over the buckets of first bytes. Neighbours in that order with a common
   prefix of ``length`` bytes are the repeated windows.
4. Anchors with very many distinct slices (a passage that very many texts share, between
   different neighbours) are cut into blocks of few windows. All windows of a block contain
   its middle, so blocks are dealt by what the middle reads.
5. At the ends of such a passage the middle lies inside while the bytes beside it differ from
   text to text: very many distinct pieces read the same middle. Their windows, ``BLOCK`` a
   piece at most, are counted by what they read (as a 128-bit digest), so that no task gets
   all pieces of a block either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.llm.blocks import _BASE, _BYTE, _INVERSE, SPAN, mix, powers, texts_of
from courtledger.llm.common import discard, keyed, stored

LENGTH, GRAM = 200, 32
#: Bytes whose windows are looked at in one go.
CHUNK = 1 << 19
#: Windows to a block of a hot anchor, and distinct slices (pieces) from which an anchor (a block) is hot.
BLOCK, HOT_SLICES = 16, 2000
#: Bytes of slices sorted together, unless one group has more (a hot one is cut before).
SORTED_BYTES = 1 << 19

_PLACE = np.uint64(20)
_ANCHORS = "rid bigint, rth bigint, anchor bigint, slice bigint, place bigint"
#: A slice's first place, its number of windows and its anchor's distance from it share a number.
_BITS = 12


def _slice_tables(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, max(SPAN, len(data)))[: len(data)], out=sums[1:])
    return sums


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def _chunk_anchors(data: np.ndarray, cuts: np.ndarray, length: int):
    """Slices of all windows within the texts that ``cuts`` divides ``data`` into."""
    n = len(data) - GRAM + 1
    down = powers(_INVERSE)
    sums = _slice_tables(data)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n])
    order = grams >> _PLACE << _PLACE | np.arange(n, dtype=np.uint64)
    low = _window_minima(order, length - GRAM + 1)
    place = (low & np.uint64((1 << 20) - 1)).astype(np.int64)
    inside = np.ones(len(place), dtype=bool)
    for cut in cuts[1:-1]:  # windows that would reach into the next text
        inside[max(0, cut - length + 1) : cut] = False
    change = np.ones(len(place), dtype=bool)
    change[1:] = (place[1:] != place[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(change & inside)
    if not len(starts):
        return None
    # A run ends where the next one begins or where windows leave their text.
    stop = np.flatnonzero(np.append(change | ~inside, True))
    ends = stop[np.searchsorted(stop, starts, "right")]
    begin, end = starts, ends + length - 1
    digest = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return grams[place[starts]], digest, starts, ends - starts, place[starts] - starts


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch["text"])
            rid, rth = batch["rid"].to_numpy(), batch["rth"].to_numpy()
            at, n = 0, len(offsets) - 1
            while at < n:
                end = int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1
                end = min(max(end, at + 1), n)
                base, top = int(offsets[at]), int(offsets[end])
                if end == at + 1:  # one text, in overlapping chunks if it is long
                    spans = [(b, min(b + CHUNK, top)) for b in range(base, max(base + 1, top - length + 1), CHUNK - length + 1)]
                else:
                    spans = [(base, top)]
                for a, b in spans:
                    if b - a < length:
                        continue
                    cuts = np.array([0, b - a]) if end == at + 1 else offsets[at : end + 1] - base
                    found = _chunk_anchors(data[a:b], cuts, length)
                    if found is None:
                        continue
                    gram, digest, starts, counts, back = found
                    text = np.searchsorted(offsets, starts + a, "right") - 1
                    columns = [rid[text], rth[text], gram.view(np.int64), digest.view(np.int64)]
                    columns.append((starts + a - offsets[text]) << 2 * _BITS | counts << _BITS | back)
                    names = ["rid", "rth", "anchor", "slice", "place"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                at = end

    return run


def _words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one number that sorts as they do."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | text[at + k].astype(np.uint64)
    return out


def _sort_directly(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """``places`` in the order of their first ``length`` bytes; only ties are looked at further."""
    order = places.copy()
    group = np.zeros(len(order), np.int64)
    open_rows = np.arange(len(order))
    depth = 0
    while len(open_rows) and depth < length:
        rows = open_rows
        key = _words_at(text, order[rows] + depth)
        by = np.lexsort((key, group[rows]))
        order[rows] = order[rows][by]
        key, owner = key[by], group[rows][by]
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        # A group is named by the row at which it starts, which never changes its place.
        group[rows] = rows[np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))]
        alone = fresh & np.append(fresh[1:], True)
        open_rows = rows[~alone]
        depth += 8
    return order


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """All places of ``text`` in the order of the suffixes that begin there.

    ``text`` holds bytes plus one, with 0 behind every slice. Suffixes are compared over
    ``length`` symbols at least; those equal so far stand in any order.
    """
    n = len(text)
    different = np.flatnonzero(text[1:] != text[:-1])
    # Smaller than the successor: the next different symbol is larger.
    after = np.searchsorted(different, np.arange(n))
    some = after < len(different)
    turn = different[after[some]]
    small = text == 0
    small[some] |= text[turn + 1] > text[turn]
    padded = np.concatenate([text, np.zeros(length + 16, np.uint8)])
    places = np.flatnonzero(small)
    # Suffixes equal over the whole length, of which there are many, are sorted once.
    sums = _slice_tables(padded)
    hashes = (sums[places + length] - sums[places]) * powers(_INVERSE, max(SPAN, n))[places]
    _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
    sorted_ = _sort_directly(padded, places[example], length)
    rank = np.empty(n, np.int64)
    rank[sorted_] = np.arange(len(sorted_))
    direct = places[np.argsort(rank[places[example]][which], kind="stable")]
    edges = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    parts = []

    def hand_on(found: np.ndarray, current: int) -> np.ndarray:
        """Deals the larger suffixes just before ``found`` to their buckets, in this order."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        before = before[np.argsort(text[before], kind="stable")]
        begins = np.searchsorted(text[before], np.arange(257))
        own = before[:0]
        for symbol in np.flatnonzero(np.diff(begins)):
            part = before[begins[symbol] : begins[symbol + 1]]
            if symbol == current:
                own = part
            else:
                waiting[symbol].append(part)
        return own

    for current in range(256):
        # In a bucket the larger suffixes come first; a run of one symbol feeds itself.
        front = np.concatenate(waiting[current]) if waiting[current] else direct[:0]
        while len(front):
            parts.append(front)
            front = hand_on(front, current)
        rest = direct[edges[current] : edges[current + 1]]
        parts.append(rest)
        hand_on(rest, current)
    return np.concatenate(parts)


def repeated_windows(slices: list[bytes], windows: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each slice the runs of its first ``windows`` windows that another one equals."""
    sizes = np.array([len(x) for x in slices], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    raw = np.frombuffer(b"\x00".join(slices) + b"\x00", np.uint8)
    text = raw + np.uint8(1)  # no byte of UTF-8 is above 0xF7
    text[begins + sizes] = 0
    wanted = np.zeros(len(text), dtype=bool)
    for begin, count in zip(begins.tolist(), windows):
        wanted[begin : begin + count] = True
    order = suffix_order(text, length)
    order = order[wanted[order]]
    # Common prefixes of neighbours, eight bytes at a time, as long as they agree.
    pairs, depth = np.arange(len(order) - 1), 0
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    while depth < length and len(pairs):
        depth = min(depth, length - 8)
        same = _words_at(padded, order[pairs] + depth) == _words_at(padded, order[pairs + 1] + depth)
        pairs = pairs[same]
        depth += 8
    twice = np.zeros(len(text) + 1, dtype=bool)
    twice[order[pairs]] = True
    twice[order[pairs + 1]] = True
    out = []
    for begin, count in zip(begins.tolist(), windows):
        edges = np.flatnonzero(np.diff(twice[begin : begin + count].astype(np.int8), prepend=0, append=0))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


_RUNS = "array<struct<low:int,high:int>>"


def _search(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys, digests, slices, windows = zip(*held)
            runs = repeated_windows(list(slices), list(windows), length)
            kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            runs = pa.array([[{"low": a, "high": b} for a, b in r] for r in runs], kind)
            arrays = [pa.array(keys, pa.int64()), pa.array(digests, pa.int64()), runs]
            return pa.RecordBatch.from_arrays(arrays, ["key", "digest", "runs"])

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("key", "digest", "bytes", "windows")]
            for row in zip(*columns):
                if size >= SORTED_BYTES and row[0] != held[-1][0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield flush()

    return run


def _counted_windows(equal: DataFrame, length: int) -> DataFrame:
    """``key, digest, runs`` as ``_search`` gives them, by counting equal windows of a key."""
    read = F.expr(
        f"transform(sequence(0, windows - 1), k -> unhex(md5(substring(bytes, k + 1, {length}))))"
    )
    windows = stored(equal.select("key", "digest", "met", F.posexplode(read).alias("no", "window")), "windows")
    several = windows.groupBy("key", "window").agg(F.sum("met").alias("met")).filter("met > 1")
    numbers = (
        windows.join(several.select("key", "window"), ["key", "window"], "left_semi")
        .groupBy("key", "digest")
        .agg(F.array_sort(F.collect_set("no")).alias("nos"))
    )
    runs = F.expr(
        "zip_with(filter(nos, k -> NOT array_contains(nos, k - 1)), filter(nos, k -> NOT array_contains(nos, k + 1)), "
        "(a, b) -> named_struct('low', a, 'high', b + 1))"
    )
    return numbers.select("key", "digest", runs.alias("runs"))


def _repeated_slices(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Slices of anchors met twice, one row for each occurrence, and the runs of windows of
    each distinct slice (``anchor, slice, runs``) that also occur elsewhere."""
    anchors = stored(rows.select("rid", "rth", "text").mapInArrow(_anchors(length), _ANCHORS), "anchors")
    twice = anchors.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1")
    place, mask = F.col("place"), (1 << _BITS) - 1
    met = anchors.join(twice.select("anchor"), "anchor").select(
        "rid",
        "rth",
        "anchor",
        "slice",
        F.shiftright(place, 2 * _BITS).alias("low"),
        F.shiftright(place, _BITS).bitwiseAND(mask).cast("int").alias("n"),
        place.bitwiseAND(mask).cast("int").alias("back"),
    )
    slices = stored(met, "slices")
    discard(anchors)

    one = [F.first(c).alias(c) for c in ("rid", "rth", "low", "n", "back")]
    distinct = stored(
        slices.groupBy("anchor", "slice").agg(F.count("*").alias("times"), *one), "distinct"
    )
    kinds = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"))
    open_slices = distinct.join(kinds.filter("kinds > 1"), "anchor")
    # Everything is known of a slice that occurs twice as a whole; it stays in the search,
    # since windows of other slices may equal its own.
    whole = distinct.filter("times > 1").select(
        "anchor", "slice", F.array(F.struct(F.lit(0).alias("low"), F.col("n").alias("high"))).alias("runs")
    )

    # Positions are counted in bytes, so the text is taken as bytes before it is cut.
    fetched = open_slices.join(rows.select("rid", "rth", "text"), ["rid", "rth"])
    cut = fetched.select(
        "anchor",
        "slice",
        "times",
        "kinds",
        "n",
        "back",
        F.substring(F.col("text").cast("binary"), F.col("low").cast("int") + 1, F.col("n") + length - 1).alias("bytes"),
    )
    cool = cut.filter(F.col("kinds") <= HOT_SLICES).select(
        "anchor", "slice", "times", F.col("anchor").alias("key"), F.lit(0).alias("at"), F.col("n").alias("windows"), "bytes"
    ).withColumn("hot", F.lit(False))
    block = F.explode(
        F.sequence(F.floor((F.col("back") - F.col("n") + 1) / BLOCK), F.floor(F.col("back") / BLOCK))
    ).alias("block")
    high = F.col("back") - BLOCK * F.col("block")
    hot = (
        cut.filter(F.col("kinds") > HOT_SLICES)
        .select("*", block)
        .withColumn("at", F.greatest(high - BLOCK + 1, F.lit(0)).cast("int"))
        .withColumn("windows", (F.least(high, F.col("n") - 1) - F.col("at") + 1).cast("int"))
        .select(
            "anchor",
            "slice",
            "times",
            F.xxhash64(
                "anchor", "block", F.substring(F.col("bytes"), high.cast("int") + 1, F.lit(length - BLOCK + 1))
            ).alias("key"),
            "at",
            "windows",
            F.substring(F.col("bytes"), F.col("at") + 1, F.col("windows") + length - 1).alias("bytes"),
            F.lit(True).alias("hot"),
        )
    )
    pieces = stored(cool.unionByName(hot).withColumn("digest", F.xxhash64("bytes")), "pieces")
    equal = pieces.groupBy("key", "digest", "bytes", "windows").agg(F.sum("times").alias("met"))
    # Cool keys have no more pieces than their anchor has slices.
    blocks = pieces.filter("hot").select("key", "digest", "bytes", "windows").distinct().groupBy("key")
    crowded = blocks.agg(F.count("*").alias("kinds")).filter(F.col("kinds") > HOT_SLICES)
    crowded = stored(crowded.select("key"), "crowded")
    found = equal.select("key", "digest", "bytes", "windows").join(crowded, "key", "left_anti")
    found = found.repartition("key").sortWithinPartitions("key")
    found = found.mapInArrow(_search(length), f"key bigint, digest bigint, runs {_RUNS}")
    found = found.unionByName(_counted_windows(equal.join(crowded, "key", "left_semi"), length))
    everything = F.array(F.struct(F.lit(0).alias("low"), F.col("windows").alias("high")))
    runs = (
        pieces.filter("times = 1")
        .join(equal.select("key", "digest", "met"), ["key", "digest"])
        .join(found, ["key", "digest"])
        .withColumn("runs", F.when(F.col("met") > 1, everything).otherwise(F.col("runs")))
        .filter(F.size("runs") > 0)
    )
    runs = runs.select(
        "anchor",
        "slice",
        F.expr("transform(runs, r -> named_struct('low', r.low + at, 'high', r.high + at))").alias("runs"),
    )
    return slices, whole.unionByName(runs)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        kept, spans = [], []
        for text, found in zip(batch["text"], batch["found"].to_pylist()):
            raw = text.as_py().encode()
            merged: list[list[int]] = []
            for span in sorted(found or [], key=lambda x: x["start"]):
                if merged and span["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span["stop"])
                else:
                    merged.append([span["start"], span["stop"]])
            edges = [0, *(x for span in merged for x in span), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans.append([{"start": a, "stop": b} for a, b in merged])
        arrays = [batch["doc_id"], pa.array([len(t.as_py().encode()) for t in batch["text"]], pa.int64())]
        arrays += [pa.array(spans, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: each row with the byte ranges removed and what stays.

    A byte goes when a string of ``length`` bytes over it also starts anywhere else in the
    table, the same text included; all copies go. Texts are UTF-8 bytes, a null text is
    empty, texts shorter than ``length`` stay. Rows that repeat id and text are copies of each
    other. ``kept`` is binary, since a cut may fall inside a character.
    """
    rows = keyed(docs)
    slices, runs = _repeated_slices(rows, length)
    spans = (
        slices.select("rid", "rth", "anchor", "slice", "low")
        .join(runs, ["anchor", "slice"])
        .select("rid", "rth", "low", F.explode("runs").alias("run"))
        .groupBy("rid", "rth")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("low") + F.col("run.low")).alias("start"),
                    (F.col("low") + F.col("run.high") + length - 1).alias("stop"),
                )
            ).alias("found")
        )
    )
    return rows.join(spans, ["rid", "rth"], "left").select("doc_id", "text", "found").mapInArrow(
        _remove, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    )
