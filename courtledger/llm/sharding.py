"""Shards of even size that keep linked documents together: balanced label propagation.

Every document starts in a shard dealt by hash. In a round each linked document looks at the
shards of its neighbours (documents of the same link), weighted by bytes, and asks to move to
the heaviest one that still has room. Requests are dealt to hash buckets; per target the
buckets are accepted in order as long as their bytes fit its quota, so no task needs all
requests of a target. Rounds end when nothing moves. A link with more bytes than a shard
holds is thus split over as few shards as have room. Documents without neighbours are placed
last, into what each shard lacks, which makes the sizes even.

DataFrame joins and aggregations only; each round is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtledger.llm.common import discard, stored

#: Of requests to a target, of single documents, and of slots in a shard.
BUCKETS = 4096
MOST_ROUNDS = 12


def _bucket(*columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def _running(partition: list[str], order: str, value: str, before: bool = False) -> Column:
    window = Window.partitionBy(*partition).orderBy(order)
    window = window.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    return F.coalesce(F.sum(value).over(window), F.lit(0).cast("bigint"))


def _move(linked: DataFrame, capacity: float, shards: int, round_no: int) -> DataFrame:
    """One round: the linked documents with ``shard`` after it, and whether they ``moved``."""
    spark = linked.sparkSession
    loads = linked.groupBy("shard").agg(F.sum("size").alias("load"))
    # One row for each shard. Room for a few documents only counts as none: it would hold up
    # requests that find room elsewhere.
    left = F.lit(capacity) - F.coalesce("load", F.lit(0))
    room = (
        spark.range(shards)
        .select(F.col("id").cast("int").alias("shard"))
        .join(loads, "shard", "left")
        .select("shard", F.when(left > capacity / 200, left).otherwise(0.0).alias("room"))
    )
    votes = linked.groupBy("link", "shard").agg(F.sum("size").alias("weight"))
    votes = votes.join(F.broadcast(room), "shard")
    # A shard without room is no target. Documents of a heavy link stay in it; those of others
    # follow their neighbours to the heaviest shard with room.
    heaviest = votes.groupBy("link").agg(
        F.sum("weight").alias("together"),
        F.max(F.struct("weight", -F.col("shard"), "room")).alias("best"),
        F.max(F.when(F.col("room") > 0, F.struct("weight", -F.col("shard")))).alias("free"),
    )
    targets = heaviest.select(
        "link",
        (-F.col("best.col2")).alias("best"),
        ((F.col("best.room") <= 0) & (F.col("together") <= capacity / 2)).alias("leaves"),
        (-F.col("free.col2")).alias("target"),
        F.col("free.weight").alias("target_weight"),
    )
    own = votes.select("link", "shard", "weight")
    asked = (
        linked.join(targets, "link")
        .join(own, ["link", "shard"])
        .withColumn("bucket", _bucket("uid", F.lit(round_no)))
        .withColumn(
            "asks",
            F.coalesce(
                (F.col("shard") != F.col("target"))
                & (F.col("leaves") | (F.col("shard") != F.col("best")))
                & (F.col("leaves") | (F.col("weight") < F.col("target_weight")) | (F.col("weight") == F.col("target_weight")) & (F.col("target") < F.col("shard"))),
                F.lit(False),
            ),
        )
    )
    # At most BUCKETS rows for each shard.
    queue = (
        asked.filter("asks")
        .groupBy("target", "bucket")
        .agg(F.sum("size").alias("size"))
        .withColumn("total", _running(["target"], "bucket", "size"))
        .join(room.withColumnRenamed("shard", "target"), "target")
        .groupBy("target")
        .agg(F.coalesce(F.max(F.when(F.col("total") <= F.col("room"), F.col("bucket"))), F.lit(-1)).alias("upto"))
    )
    moved = F.coalesce(F.col("asks") & (F.col("bucket") <= F.col("upto")), F.lit(False))
    return asked.join(F.broadcast(queue), "target", "left").select(
        "uid", "link", "size", F.when(moved, F.col("target")).otherwise(F.col("shard")).alias("shard"), moved.alias("moved")
    )


def balanced_shards(nodes: DataFrame, shards: int) -> DataFrame:
    """``uid, shard, slot`` for ``uid, link, size``: distinct numbers, links, bytes.

    Documents with the same ``link`` are neighbours; a null link has none. Slots of a shard
    count from 0 without gaps. An empty table gives no rows.
    """
    spark = nodes.sparkSession
    nodes = stored(nodes.select("uid", "link", "size"), "nodes")
    total = nodes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    capacity = total / shards
    several = nodes.filter("link IS NOT NULL").groupBy("link").agg(F.count("*").alias("n")).filter("n > 1").select("link")
    start = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard")
    linked = stored(nodes.join(several, "link").select("uid", "link", "size", start), "linked")
    for round_no in range(MOST_ROUNDS):
        after = stored(_move(linked, capacity, shards, round_no), "moved")
        discard(linked)
        linked = after.drop("moved")
        if not after.filter("moved").limit(1).count():
            break

    lacks = (
        spark.range(shards)
        .select(F.col("id").cast("int").alias("shard"))
        .join(linked.groupBy("shard").agg(F.sum("size").alias("load")), "shard", "left")
        .select("shard", F.greatest(F.lit(capacity) - F.coalesce("load", F.lit(0)), F.lit(0.0)).alias("lack"))
    )
    singles = nodes.join(linked.select("uid"), "uid", "left_anti").withColumn("bucket", _bucket("uid"))
    # BUCKETS rows at most, over which the shards' shares are laid end to end.
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = singles.groupBy("bucket").agg(F.sum("size").alias("size")).select(
        "bucket", (F.coalesce(F.sum("size").over(whole), F.lit(0)) + F.col("size") / 2).alias("middle")
    )
    until = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    shares = lacks.select("shard", F.sum("lack").over(until).alias("upto"), "lack")
    last = F.lit(shards - 1)
    shares = shares.select("shard", (F.col("upto") - F.col("lack")).alias("from"), F.when(F.col("shard") == last, float("inf")).otherwise(F.col("upto")).alias("upto"))
    deal = buckets.join(F.broadcast(shares), (F.col("middle") >= F.col("from")) & (F.col("middle") < F.col("upto")))
    placed = singles.join(F.broadcast(deal.select("bucket", "shard")), "bucket").select("uid", "shard")
    assigned = stored(placed.unionByName(linked.select("uid", "shard")).withColumn("bucket", _bucket(F.lit(1), "uid")), "assigned")

    counts = assigned.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    bases = counts.select("shard", "bucket", _running(["shard"], "bucket", "n", before=True).alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("uid")) - 1
    return assigned.withColumn("within", within).join(
        F.broadcast(bases), ["shard", "bucket"]
    ).select("uid", "shard", (F.col("base") + F.col("within")).cast("bigint").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row; equal texts are linked.

    ``size`` is the bytes of the text and one more; a null text has none and is linked with
    empty ones. Repeated rows and null ids are documents like others. Other columns are not
    read.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("uid"),
    )
    rows = stored(rows, "rows").withColumn("link", F.xxhash64("hash", "text_crc32", "size"))
    return rows.join(balanced_shards(rows, shards), "uid").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
