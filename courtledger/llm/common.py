"""Row keys, free column names, and connected components by Spark joins."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtledger import session

NO_ID = -(2**63)


#: Shuffle files are deleted at the end of a query that runs under this setting.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder; the shuffle files that made it go at once."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        return session.stored(df, label)
    finally:
        spark.conf.set(_CLEANUP, before)


_BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches for Python end at about ``most`` bytes (one row at least) in what runs meanwhile.

    The JVM holds a batch outside its heap, in vectors that double as they grow, and the heap
    may be full at the same time; ten thousand rows of long texts are too many then.
    """
    before = spark.conf.get(_BYTES_PER_BATCH, None)
    spark.conf.set(_BYTES_PER_BATCH, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BYTES_PER_BATCH)
        else:
            spark.conf.set(_BYTES_PER_BATCH, before)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        for folder in folders:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets Spark hand this package to its Python workers, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    handle, path = tempfile.mkstemp(prefix=f"{root.name}-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_id(df: DataFrame) -> Column:
    """The id as a key that joins: a null id becomes the smallest number."""
    return F.coalesce(df["doc_id"].cast("bigint"), F.lit(NO_ID))


def text_hash(df: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(df["text"], F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """``rid, rth, doc_id, text``: a row is known by its id and the hash of its text.

    Rows that agree in both are copies of each other, with one result for all of them. A
    null text counts as empty. No other column is carried, so none can clash.
    """
    ship(docs.sparkSession)
    return docs.select(
        row_id(docs).alias("rid"),
        text_hash(docs).alias("rth"),
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over the edges ``a, b``.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    its smallest neighbour, then its smaller neighbours and itself to the smallest one. Each
    step is one window over the neighbours of a node; chains shorten by half, so few rounds are
    needed. Each round is stored, which cuts the lineage and lets a lost executor repeat one
    round only. Only a count and a sum per round come to the driver. The result's rows are edges
    as well: with new edges they may stand for those they were found from.
    """
    beside, ascending = Window.partitionBy("a"), Window.partitionBy("a").orderBy("b")
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    state, former = None, []
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.withColumn("m", F.least(F.min("b").over(beside), "a"))
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        # Equal edges stand next to each other here, so that one of them goes on.
        small = large.select(
            "a", "b", F.first("b").over(ascending).alias("m"), F.lag("b").over(ascending).alias("before")
        )
        small = small.filter("before IS NULL OR before <> b").select(
            F.when(F.col("before").isNull(), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        pairs = stored(small, "components")
        discard(*former)
        former = [pairs]
        now = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("b").alias("node")).distinct()
    # Each node has one edge left, to the smallest one.
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
