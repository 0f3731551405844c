"""Near duplicates by one-permutation hashing with optimal densification.

Every text becomes a set of word shingles. One hash function deals a set's shingles into
bins; the smallest hash of each bin is kept, and an empty bin borrows from the first filled
bin of a fixed random walk of its own, so that every bin agrees between two sets with a
probability equal to their Jaccard similarity, also for tiny sets. Groups of ``ROWS`` bins
are the keys of banded buckets.

* Equal sets are one class from the start; everything after works on classes.
* In a bucket every class is linked to the smallest one only: a star, as many edges as
  members. Edges whose sketches rule the similarity out go; the others are confirmed on the
  full sets, computed anew from the texts.
* A star can miss a link between two members that are both unlike its centre. So buckets
  that still hold several components are looked at again. Each gets a second star, around a
  class that its hash with the bucket picks from the largest component, so that a class meets
  other centres in each of its buckets. What then still lies outside a bucket's largest
  component is compared with the other components, within the join, by bit sets of all
  shingles: a bit that only one side has is a shingle that the other lacks, which bounds the
  similarity from above. Pairs that remain leave the join in one of their buckets only and are
  confirmed. So two classes that share a bucket are confirmed, ruled out, or connected anyway.

A pair at similarity s shares no bucket with probability (1 - s^4)^32: 5e-8 at 0.8. The
sketch drops such a pair with probability 7e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtledger.llm.blocks import list_array, mix, shingle_sets, texts_of
from courtledger.llm.common import components, discard, fresh, keyed, row_id, stored, text_hash

BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
#: Of 128 one-bit samples, a pair at 0.8 differs in 13 on average, unrelated ones in 64.
SKETCH_APART = 36
#: Numbers of 64 bits in which the shingles of a set leave their marks.
MARKS = 24

_rng = np.random.default_rng(7)
#: The walk of each bin over all bins, in the order in which it looks for a filled one.
_WALK = np.stack([_rng.permutation(BINS) for _ in range(BINS)])
_BAND = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)
_SALT = _rng.integers(1, 2**63, BINS, dtype=np.uint64)
_SHIFT = np.uint64(64 - (BINS - 1).bit_length())

_PROFILE = "rid bigint, rth bigint, n bigint, h1 bigint, h2 bigint, s1 bigint, s2 bigint, bits array<bigint>, bands array<bigint>"


def _signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin; the bin is the highest bits of the hash."""
    bins = (shingles >> _SHIFT).astype(np.int64)
    filled = np.zeros(BINS, dtype=bool)
    filled[bins] = True
    first = np.searchsorted(bins, np.arange(BINS))
    if not filled.all():
        empty = np.flatnonzero(~filled)
        walk = _WALK[empty]
        source = walk[np.arange(len(empty)), np.argmax(filled[walk], axis=1)]
        first[empty] = first[source]
    return shingles[first]


def _profiles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch["text"])
            n = len(offsets) - 1
            counts, digests = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64)
            signatures = np.zeros((n, BINS), np.uint64)
            marks = np.zeros((n, MARKS * 64), dtype=bool)
            for k, shingles in enumerate(shingle_sets(data, offsets, size)):
                counts[k] = len(shingles)
                if len(shingles):
                    # Sums of mixed hashes: equal for equal sets, whatever their order.
                    digests[k] = mix(shingles).sum(), mix(shingles ^ _BAND[0]).sum()
                    signatures[k] = _signature(shingles)
                    marks[k, (shingles % np.uint64(MARKS * 64)).astype(np.int64)] = True
            mixed = mix(signatures ^ _SALT)
            grouped = mixed.reshape(n, BANDS, ROWS)
            bands = _BAND * np.ones((n, 1), np.uint64)
            for r in range(ROWS):
                bands = mix(bands + grouped[:, :, r])
            marked = np.packbits(marks, axis=1).view(np.int64)
            bits = np.packbits((mixed >> np.uint64(63)).astype(np.uint8), axis=1).view(np.int64)
            arrays = [batch["rid"], batch["rth"], pa.array(counts)]
            arrays += [pa.array(digests[:, k].view(np.int64)) for k in range(2)]
            arrays += [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(2)]
            arrays.append(list_array(marked.ravel(), np.full(n, MARKS), pa.int64()))
            lengths = np.where(counts > 0, BANDS, 0)
            arrays.append(list_array(bands[counts > 0].reshape(-1).view(np.int64), lengths, pa.int64()))
            names = ["rid", "rth", "n", "h1", "h2", "s1", "s2", "bits", "bands"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _possible(threshold: int) -> Column:
    """Whether sketches and sizes of ``a_*`` and ``b_*`` allow the similarity."""
    apart = F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1"))) + F.bit_count(
        F.col("a_s2").bitwiseXOR(F.col("b_s2"))
    )
    sizes = 100 * F.least("a_n", "b_n") >= threshold * F.greatest("a_n", "b_n")
    return (apart <= SKETCH_APART) & sizes


def _facts(classes: DataFrame) -> DataFrame:
    """``c, n, s1, s2`` of every class, ``marked``, how many marks it has, and these as numbers."""
    marks = [F.coalesce(F.col("bits")[k], F.lit(0)).alias(f"m{k}") for k in range(MARKS)]
    marked = F.expr(" + ".join(f"bit_count(bits[{k}])" for k in range(MARKS)))
    return classes.select("c", "n", "s1", "s2", marked.alias("marked"), *marks)


def _allowed(threshold: int) -> Column:
    """Whether the marks of all shingles (``a_m0`` and so on) allow it as well.

    A set with ``n`` shingles and ``marked`` marks has ``marked - both`` that the other lacks. Of
    these the join's generated method holds the long sum once, so that it is small enough to be
    compiled.
    """
    both = F.expr(" + ".join(f"bit_count(a_m{k} & b_m{k})" for k in range(MARKS)))
    least = [
        threshold * (F.col(f"{x}_n") + F.col(f"{y}_marked")) - 100 * (F.col(f"{x}_n") - F.col(f"{x}_marked"))
        for x, y in ("ab", "ba")
    ]
    return _possible(threshold) & ((100 + threshold) * both >= F.greatest(*least))


def _across(left: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: each pair of unlike components once that share a bucket and may be similar.

    ``left``: the members of buckets with several components, with the bucket's largest one,
    facts and all their ``bands``. Every bucket that such a pair shares has several components,
    so the pair meets in all of them; it leaves the join in the smallest.
    """
    facts = [c for c in left.columns if c not in ("bucket", "largest", "component")]
    sides = [
        left.select("bucket", "largest", *(F.col(c).alias(f"{x}_{c}") for c in ["component", *facts]))
        for x in "ab"
    ]
    a = sides[0].filter("a_component <> largest")
    # Of two small components each pair is met twice; the second time is left out.
    once = (F.col("b_component") == F.col("largest")) | (F.col("a_c") < F.col("b_c"))
    here = F.col("bucket") == F.array_min(F.array_intersect("a_bands", "b_bands"))
    return (
        a.join(sides[1].drop("largest"), "bucket")
        .filter((F.col("a_component") != F.col("b_component")) & once & _allowed(threshold) & here)
        .select(F.col("a_c").alias("a"), F.col("b_c").alias("b"))
    )


def _confirm(size: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = shingle_sets(*texts_of(batch["a_text"]), size)
            right = shingle_sets(*texts_of(batch["b_text"]), size)
            keep = []
            for x, y in zip(left, right):
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                keep.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked_rows(docs: DataFrame, shingle_words: int, threshold: int) -> DataFrame:
    """``rid, rth, times, n, part, least``: each distinct row and how often it is met, its set
    size, a number of its component (null without words) and the smallest id in there."""
    rows = keyed(docs)
    profiles = stored(
        rows.select("rid", "rth", "text").mapInArrow(_profiles(shingle_words), _PROFILE),
        "profiles",
    )
    # One class for each distinct set; equal sets have equal columns here, any will do.
    classes = (
        profiles.filter("n > 0")
        .groupBy("h1", "h2", "n")
        .agg(
            F.first(F.struct("rid", "rth", "s1", "s2", "bits", "bands")).alias("one"),
            F.min("rid").alias("least_id"),
        )
        .select("h1", "h2", "n", "least_id", "one.*", F.monotonically_increasing_id().alias("c"))
    )
    classes = stored(classes, "classes")
    facts = _facts(classes)

    members = classes.select("c", F.explode("bands").alias("bucket"))
    centres = (
        members.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min("c").alias("centre"))
        .filter("size > 1")
        .drop("size")
    )
    # Buckets with one class, most of them, end here.
    shared = stored(members.join(centres, "bucket"), "buckets")

    def with_facts(pairs: DataFrame) -> DataFrame:
        for side in "ab":
            named = facts.toDF(side, *(f"{side}_{c}" for c in facts.columns[1:]))
            pairs = pairs.join(named, side)
        return pairs

    def texts_of_classes(wanted: DataFrame) -> DataFrame:
        """``c, text`` of a row of each class in ``wanted``."""
        ids = classes.join(wanted, "c").select("c", "rid", "rth")
        return rows.join(ids, ["rid", "rth"]).select("c", "text")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        """The pairs ``a, b`` whose full sets are similar enough."""
        pairs = stored(pairs, f"{label}-pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
        texts = stored(texts_of_classes(ends), f"{label}-texts")
        both = pairs.join(texts.select(F.col("c").alias("a"), F.col("text").alias("a_text")), "a")
        both = both.join(texts.select(F.col("c").alias("b"), F.col("text").alias("b_text")), "b")
        found = both.select("a", "b", "a_text", "b_text").mapInArrow(
            _confirm(shingle_words, threshold), "a bigint, b bigint"
        )
        links = stored(found.distinct(), f"{label}-links")
        discard(pairs, texts)
        return links

    def mixed_buckets(placed: DataFrame) -> DataFrame:
        """``bucket, largest``: buckets with several components, and their largest one."""
        parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
        return (
            parts.groupBy("bucket")
            .agg(F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("most"))
            .filter("parts > 1")
            .select("bucket", F.col("most.component").alias("largest"))
        )

    def with_component(members: DataFrame, found: DataFrame) -> DataFrame:
        joined = members.join(found.withColumnRenamed("node", "c"), "c", "left")
        return joined.withColumn("component", F.coalesce("component", "c"))

    stars = (
        shared.filter("c <> centre")
        .groupBy(F.col("c").alias("a"), F.col("centre").alias("b"))
        .agg(F.lit(1).alias("one"))
    )
    links = confirmed(
        with_facts(stars).filter(_allowed(threshold)).select("a", "b"), "stars"
    )
    first = stored(components(links), "components")

    placed = with_component(shared.select("bucket", "c"), first)
    open_members = stored(placed.join(mixed_buckets(placed), "bucket"), "open")
    order = F.xxhash64("bucket", "c")
    middle = (
        open_members.filter("component = largest")
        .groupBy("bucket")
        .agg(F.min(F.struct(order, "c")).alias("middle"))
        .select("bucket", F.col("middle.c").alias("b"))
    )
    second = (
        open_members.filter("component <> largest")
        .join(middle, "bucket")
        .groupBy(F.col("c").alias("a"), "b")
        .agg(F.lit(1).alias("one"))
    )
    second = with_facts(second).filter(_allowed(threshold)).select("a", "b")
    # Components stand for the links they were found from.
    edges = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    again = stored(components(edges.unionByName(confirmed(second, "second"))), "components")

    placed = with_component(open_members.select("bucket", "c"), again)
    placed = placed.join(mixed_buckets(placed), "bucket")
    left = stored(placed.join(facts.join(classes.select("c", "bands"), "c"), "c"), "left")
    rest = _across(left, threshold).distinct()
    edges = again.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(edges.unionByName(confirmed(rest, "rest")))

    labelled = with_component(classes.select("c", "h1", "h2", "n", "least_id"), final)
    names = labelled.groupBy("component").agg(F.min("least_id").alias("least"))
    labelled = labelled.join(names, "component").select(
        "h1", "h2", "n", "least", F.col("component").alias("part")
    )
    distinct = profiles.groupBy("rid", "rth", "n", "h1", "h2").agg(F.count("*").alias("times"))
    return distinct.join(labelled, ["h1", "h2", "n"], "left").select("rid", "rth", "times", "n", "part", "least")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, threshold: int = 80) -> DataFrame:
    """``rid, rth, n_shingles, component``: each distinct row, its set size and its component.

    Rows are linked when 100 * intersection >= ``threshold`` * union of their shingle sets;
    the component is named by the smallest ``rid`` reachable. A text without words, an empty
    or null one, has no shingles and is linked with nothing: its component is its own id.
    Rows that repeat id and text are one row here. A null id counts as the smallest number.
    """
    return _linked_rows(docs, shingle_words, threshold).select(
        "rid", "rth", F.col("n").alias("n_shingles"), F.coalesce("least", "rid").alias("component")
    )


def drop_near_duplicates(
    docs: DataFrame, shingle_words: int = 5, threshold: int = 80
) -> DataFrame:
    """One document of each component, with all its columns.

    It is the one with the smallest id (a null id before all others), then text hash; of rows
    that repeat both, one. Components are told apart by number, not by id: unlike texts of one
    id, or without any, all stay. Documents without words are linked with nothing and stay.
    """
    linked = stored(_linked_rows(docs, shingle_words, threshold), "linked")
    first = linked.filter("part IS NOT NULL").groupBy("part").agg(F.min(F.struct("rid", "rth", "times")).alias("one"))
    single = first.select("one.*").filter("times = 1").unionByName(
        linked.filter("part IS NULL").select("rid", "rth", "times")
    )
    several = first.select("one.*").filter("times > 1")

    names = {c: fresh(docs, f"_{c}") for c in ("rid", "rth", "uid")}
    keys = [names["rid"], names["rth"]]
    marked = docs.withColumns({names["rid"]: row_id(docs), names["rth"]: text_hash(docs)})

    def rows_of(kept: DataFrame) -> DataFrame:
        return marked.join(kept.select(*(F.col(c).alias(names[c]) for c in ("rid", "rth"))), keys, "left_semi")

    # Equal rows get numbers once; only these meet, and the smallest stays.
    repeated = stored(rows_of(several).withColumn(names["uid"], F.monotonically_increasing_id()), "repeated")
    least = repeated.groupBy(*keys).agg(F.min(names["uid"]).alias(names["uid"])).select(names["uid"])
    once = repeated.join(least, names["uid"], "left_semi").select(*docs.columns)
    return rows_of(single).select(*docs.columns).unionByName(once)
