"""A mix of sources in which every source has a chosen weight.

The words of a source, document after document, are packed into blocks of ``BLOCK`` words. A
source's target says how many slots of the mix it fills, and how much of its last slot. The mix
is dealt to output shards of ``SHARD_SLOTS`` slots each:

* Every shard draws its source counts from a multinomial distribution over the slots of all
  sources. With many sources the draw goes down a tree: first groups of ``FAN`` sources, then
  the members of a group.
* Draws miss the slots wanted by chance, so slots drawn beyond a source's number go, by rank, to
  the sources that were drawn too seldom. Each source then has exactly its slots.
* The slots of a source are numbered through all shards. A slot's number goes through a
  pseudorandom permutation of the source's blocks, another one for each pass over them, which
  names the block that fills the slot.
* Blocks join slots by source and block.

All draws depend on the seed and on numbers only, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtledger.llm.blocks import first_of_text, groups, mix, texts_of, word_bounds
from courtledger.llm.common import keyed, row_id, ship, stored, text_hash
from courtledger.llm.ordering import ordered

BLOCK = 256
SHARD_SLOTS = 1024
FAN = 1024
#: Shards whose draws one row of a group carries.
TOGETHER = 1024
SEED = 20_250_301

# Weights of the sources in code point order, repeating, and the size of the mix.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2

WORD = r"[^\x20\x09-\x0D]+"


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch["text"])
        counts = []
        for low, high in groups(offsets):
            base = offsets[low]
            cuts = offsets[low : high + 1] - base
            starts, _ = word_bounds(data[base : offsets[high]], cuts)
            counts.append(np.diff(first_of_text(starts, cuts)))
        sizes = np.concatenate(counts) if counts else np.empty(0, np.int64)
        arrays = [*(batch[c] for c in ("rid", "rth", "doc_id", "source")), pa.array(sizes.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, ["rid", "rth", "doc_id", "source", "size"])


# ---- targets -----------------------------------------------------------------


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = MOST_REPEATS
) -> DataFrame:
    """``sid, source, source_size, first_word, weight, target`` of ``source, size``.

    A source stops at ``repeats`` times its size, and what it leaves goes to the others by weight.
    In ascending order of size by weight, the sources that stop are the first ones: up to where
    the rest, shared among those that follow, asks none of them for more than it may give.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    numbered = ordered(totals, order, "sources", sums=["source_size"], place="sid")
    number = F.array(*[F.lit(w) for w in weights])
    weighted = numbered.withColumn(
        "weight", F.element_at(number, (F.col("sid") % len(weights) + 1).cast("int")).cast("bigint")
    )
    by_need = [F.col("source_size") / F.col("weight"), F.col("sid")]
    plain = weighted.withColumnRenamed("source_size_before", "first_word")
    ranked = (
        ordered(plain, by_need, "needs", sums=["source_size", "weight"], place="rank")
        .withColumnRenamed("source_size_before", "smaller")
        .withColumnRenamed("weight_before", "lighter")
    )
    whole = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, every = whole.words or 0, whole.weights or 0
    left = F.lit(share * words) - repeats * F.col("smaller")
    level = left / (F.lit(every) - F.col("lighter"))
    cap = (repeats * F.col("source_size")).cast("double")
    # The first source that is not asked for more than it may give, and all after it, share.
    open_ = ranked.filter(level * F.col("weight") <= cap).agg(F.min(F.struct("rank", "smaller", "lighter")).alias("f")).first()
    if open_.f is None:
        target = cap
    else:
        rest = share * words - repeats * open_.f.smaller
        shared = F.col("weight") * F.lit(float(rest)) / F.lit(float(every - open_.f.lighter))
        target = F.when(F.col("rank") < open_.f.rank, cap).otherwise(shared)
    return ranked.select(
        "sid", "source", "source_size", "first_word", "weight", target.alias("target")
    )


# ---- permutations ------------------------------------------------------------


def _feistel(x: np.ndarray, half: np.ndarray, key: np.ndarray, back: bool) -> np.ndarray:
    """A permutation of the numbers below 4 ** half, chosen by the key."""
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for turn in range(3, -1, -1) if back else range(4):
        salt = mix(key + np.uint64(turn))
        if back:
            left, right = right ^ (mix(left ^ salt) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ salt) & mask)
    return (left << half) | right


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Where each ``x`` below its ``n`` goes in the permutation of its key; ``back`` undoes it.

    Numbers beyond ``n`` are walked on until they are below again, which keeps it one to one.
    """
    x, n, key = (np.asarray(a).astype(np.uint64) for a in (x, n, key))
    bits = np.frompyfunc(lambda v: max(1, (int(v) - 1).bit_length()), 1, 1)
    distinct, which = np.unique(n, return_inverse=True)
    half = ((bits(distinct).astype(np.uint64) + np.uint64(1)) // np.uint64(2))[which]
    out = _feistel(x, half, key, back)
    far = np.flatnonzero(out >= n)
    while len(far):
        out[far] = _feistel(out[far], half[far], key[far], back)
        far = far[out[far] >= n[far]]
    return out.astype(np.int64)


def _pass_key(sid: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(sid.astype(np.uint64) + np.uint64(seed)) + turn.astype(np.uint64))


def _slots_wanted(sid, size, words, block: int, repeats: int, seed: int):
    """For each source its blocks, its slots, and the words taken of the last slot's block.

    All blocks but the last one of a source are full; where in each pass the short one comes
    follows from undoing the permutation.
    """
    blocks = -(-size // block)
    short = blocks * block - size  # words that the last block lacks
    full = np.zeros(len(sid), np.int64)
    at = np.zeros((repeats, len(sid)), np.int64)
    some = np.flatnonzero(blocks)
    for turn in range(repeats):
        key = _pass_key(sid[some], np.full(len(some), turn), seed)
        at[turn, some] = permuted(blocks[some] - 1, blocks[some], key, back=True) + turn * blocks[some]
    slots = -(-words // block)
    for _ in range(repeats):  # each short block met may ask for one slot more
        met = (at < slots).sum(axis=0)
        slots = np.minimum(-(-(words + met * short) // block), repeats * blocks)
    met = (at < slots - 1).sum(axis=0)
    full = (slots - 1) * block - met * short
    return blocks, slots, np.where(slots > 0, words - full, 0)


def _wanted(block: int, repeats: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, size = (batch[c].to_numpy().astype(np.int64) for c in ("sid", "source_size"))
            words = np.minimum(np.rint(batch["target"].to_numpy()).astype(np.int64), repeats * size)
            found = _slots_wanted(sid, size, words, block, repeats, seed)
            yield pa.RecordBatch.from_arrays(
                [batch["sid"], *(pa.array(a) for a in found)], ["sid", "blocks", "slots", "last_words"]
            )

    return run


# ---- draws -------------------------------------------------------------------


def _draw(seed: int, level: int):
    """Splits each shard's count among the children of a node, in proportion to their slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, nodes, counts = [], [], []
            for row in batch.to_pylist():
                weights = np.array([c["slots"] for c in row["children"]], np.float64)
                names = np.array([c["node"] for c in row["children"]], np.int64)
                chances = weights / weights.sum()
                for shard in row["shards"]:
                    rng = np.random.default_rng([seed, level, row["node"], shard["shard"]])
                    drawn = rng.multinomial(shard["n"], chances)
                    hit = np.flatnonzero(drawn)
                    shards.append(np.full(len(hit), shard["shard"], np.int64))
                    nodes.append(names[hit])
                    counts.append(drawn[hit])
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (shards, nodes, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["shard", "node", "n"])

    return run


def _drawn(wanted: DataFrame, total: int, n_sources: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, sid, n``: how many slots of each shard the draw gives to each source."""
    spark = wanted.sparkSession
    levels = 1
    while FAN**levels < n_sources:
        levels += 1
    shards = -(-total // shard_slots)
    last = total - (shards - 1) * shard_slots
    state = spark.range(shards).select(
        F.col("id").alias("shard"),
        F.lit(0).cast("bigint").alias("node"),
        F.when(F.col("id") == shards - 1, last).otherwise(shard_slots).cast("bigint").alias("n"),
    )
    for level in range(levels - 1, -1, -1):
        child = F.floor(F.col("sid") / FAN**level).cast("bigint")
        children = (
            wanted.filter("slots > 0")
            .groupBy(child.alias("node"))
            .agg(F.sum("slots").alias("slots"))
            .groupBy(F.floor(F.col("node") / FAN).cast("bigint").alias("parent"))
            # At most FAN children, in a fixed order.
            .agg(F.array_sort(F.collect_list(F.struct("node", "slots"))).alias("children"))
        )
        asked = state.groupBy("node", F.floor(F.col("shard") / TOGETHER).alias("together")).agg(
            F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("shards")
        )
        joined = asked.join(children, asked["node"] == children["parent"]).select("node", "shards", "children")
        state = joined.mapInArrow(_draw(seed, level), "shard bigint, node bigint, n bigint")
        state = stored(state, f"drawn-{level}")
    return state.withColumnRenamed("node", "sid")


def _numbered_draws(drawn: DataFrame) -> DataFrame:
    """Adds ``first``: slots of the same source in the shards before.

    Shards are added up in groups first, so that no window runs over all shards of a source.
    """
    grouped = drawn.withColumn("together", F.floor(F.col("shard") / TOGETHER))
    before = Window.partitionBy("sid").orderBy("together").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("sid", "together").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = grouped.groupBy("sid", "together").agg(F.sum("n").alias("sum"))
    sums = sums.select("sid", "together", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("earlier"))
    return (
        grouped.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(sums, ["sid", "together"])
        .select("shard", "sid", "n", (F.col("inner") + F.col("earlier")).alias("first"))
    )


def _block_of(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, slot, blocks = (batch[c].to_numpy().astype(np.int64) for c in ("sid", "ordinal", "blocks"))
            turn = slot // np.maximum(blocks, 1)
            found = permuted(slot - turn * blocks, blocks, _pass_key(sid, turn, seed))
            yield pa.RecordBatch.from_arrays(
                [batch["shard"], batch["sid"], pa.array(found), batch["words"]], ["shard", "sid", "block", "words"]
            )

    return run


def mixed_slots(wanted: DataFrame, block: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, sid, block, words``: the block of each slot, and how many of its words it takes."""
    whole = wanted.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    if not whole[0]:
        return wanted.sparkSession.createDataFrame([], "shard bigint, sid bigint, block bigint, words bigint")
    drawn = stored(_numbered_draws(_drawn(wanted, whole[0], whole[1], shard_slots, seed)), "draws")
    totals = drawn.groupBy("sid").agg(F.sum("n").alias("drawn"))
    got = F.coalesce("drawn", F.lit(0))
    balance = wanted.join(totals, "sid", "left").select(
        *wanted.columns,
        got.alias("drawn"),
        F.greatest(got - F.col("slots"), F.lit(0)).alias("over"),
        F.greatest(F.col("slots") - got, F.lit(0)).alias("under"),
    )
    balance = ordered(balance, [F.col("sid")], "balance", sums=["over", "under"])
    slot = ["sid", "ordinal", "blocks", "slots", "last_words"]
    each = drawn.join(balance, "sid").select(
        "shard",
        *(c for c in slot if c != "ordinal"),
        "over_before",
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("ordinal"),
    )
    spare = each.filter("ordinal >= slots").select(
        "shard", (F.col("over_before") + F.col("ordinal") - F.col("slots")).alias("k")
    )
    lacking = (
        balance.filter("under > 0")
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("under") - 1)))
        .withColumns({"k": F.col("under_before") + F.col("i"), "ordinal": F.col("drawn") + F.col("i")})
    )
    settled = spare.join(lacking.select("k", *slot), "k").select("shard", *slot)
    is_last = F.col("ordinal") == F.col("slots") - 1
    return (
        each.filter("ordinal < slots")
        .select("shard", *slot)
        .unionByName(settled)
        .withColumn("words", F.when(is_last, F.col("last_words")).otherwise(F.lit(block).cast("bigint")))
        .select("shard", "sid", "ordinal", "blocks", "words")
        .mapInArrow(_block_of(seed), "shard bigint, sid bigint, block bigint, words bigint")
    )


# ---- the mix -----------------------------------------------------------------


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    repeats: int = MOST_REPEATS,
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: the documents numbered, and what the mix takes of them.

    ``rows``: ``place`` (a number of the row), ``rid, rth, doc_id, size, source_size, target``.
    ``spans``: ``shard, sid, block, place, first, stop``: words ``first`` up to ``stop`` of a
    document; a span for each slot that takes from it. ``mixed_texts`` cuts the texts.

    Null and empty texts have no words and no spans. A null source is a source of its own, the
    last one. Repeated rows are documents of their own. A table without words gives no spans; its
    targets are 0. Texts of any length are cut into blocks. Columns other than ``doc_id``,
    ``text`` and ``source`` are ignored. Every source gives its target, rounded to whole words,
    and no word more than ``repeats`` times.
    """
    spark = docs.sparkSession
    ship(spark)
    sourced = docs.select("doc_id", "text", docs["source"].cast("string").alias("source"))
    rows = sourced.select(
        row_id(sourced).alias("rid"),
        text_hash(sourced).alias("rth"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sizes = rows.mapInArrow(_word_counts, "rid bigint, rth bigint, doc_id bigint, source string, size bigint")
    order = [F.col("source").asc_nulls_last(), F.col("rid"), F.col("rth"), F.col("size")]
    placed = ordered(stored(sizes, "sizes"), order, "documents", sums=["size"])
    targets = stored(source_targets(placed.select("source", "size"), weights, share, repeats), "targets")
    wanted = targets.select("sid", "source_size", "target").mapInArrow(
        _wanted(block, repeats, seed), "sid bigint, blocks bigint, slots bigint, last_words bigint"
    )
    wanted = stored(wanted, "wanted")
    same = placed["source"].eqNullSafe(targets["source"])
    found = placed.join(targets, same).select(
        "place",
        "rid",
        "rth",
        "doc_id",
        "size",
        "source_size",
        "target",
        "sid",
        (F.col("size_before") - F.col("first_word")).alias("start"),
    )
    found = stored(found, "sourced")
    slots = mixed_slots(wanted, block, shard_slots, seed)
    stop = F.col("start") + F.col("size")
    pieces = found.filter("size > 0").select(
        "sid",
        "place",
        "start",
        "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((stop - 1) / block))).alias("block"),
    )
    low = F.greatest(F.lit(0), F.col("block") * block - F.col("start"))
    high = F.least(F.col("size"), F.col("block") * block + F.col("words") - F.col("start"))
    spans = (
        slots.join(pieces, ["sid", "block"])
        .select("shard", "sid", "block", "place", low.alias("first"), high.alias("stop"))
        .filter("first < stop")
    )
    return found.drop("sid", "start"), spans


def mixed_texts(docs: DataFrame, rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``shard, doc_id, first, stop, text``: the words of every span, joined by blanks."""
    named = rows.select("place", "rid", "rth", "doc_id")
    # Rows equal in id and text are copies: one text serves them.
    texts = keyed(docs).select("rid", "rth", "text").dropDuplicates(["rid", "rth"])
    every = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    return (
        spans.join(named, "place")
        .join(texts, ["rid", "rth"])
        .select(
            "shard",
            "doc_id",
            "first",
            "stop",
            F.array_join(
                F.slice(every, (F.col("first") + 1).cast("int"), (F.col("stop") - F.col("first")).cast("int")), " "
            ).alias("text"),
        )
    )


def taken_words(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows with ``taken``: words that the mix takes of each, repeats counted."""
    sums = spans.groupBy("place").agg(F.sum(F.col("stop") - F.col("first")).alias("taken"))
    return rows.join(sums, "place", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
