"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    app_name: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution and UTC dates; ``settings`` wins over both.

    Shuffle parallelism is left to the caller: a cluster sets a high
    ``spark.sql.shuffle.partitions`` and adaptive execution coalesces it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The JVM never compiles methods above 8000 bytes. Projections of wide tables
        # exceed that as one fused method; below the limit they are split instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **(settings or {}),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only in a session of one process (tests, laptops) that names none is a fresh local
    folder made and recorded, so that later calls agree on it. On a cluster a local folder
    would be another one on every machine, so there the lack of a shared one is an error.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError(f"{CHECKPOINT_CONF} names no folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="courtledger-")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    context.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, options: dict[str, object] | None = None) -> DataFrame:
    """The rows as a parquet table in the shared folder, for plans that read them repeatedly.

    Later steps then depend neither on the optimizer noticing the repetition nor, when
    executors are lost, on running everything before this point again. ``options``: of the writer.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
