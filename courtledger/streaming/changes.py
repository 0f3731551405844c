"""Source files whose current contents changed, as a stream over the manifest log.

The log repeats itself: a compaction writes every file again with equal digests, a landing
that is run again may do so, and a landing for an earlier date comes after later ones. What a
reader of the tables has to know is narrower: for which files is the current landing another
content than the last time. A state for each file, its newest entry so far, answers that
across batches and restarts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from courtledger.sources.landing import MANIFEST_LOG, MANIFEST_SCHEMA, manifest_log

_STATE = "dt date, landed_at bigint, landing string, sha256 string"
#: The file, its landing that is current now, and the digest before (NULL for a new file).
CHANGE_SCHEMA = "path string, kind string, dt date, landing string, sha256 string, old_sha256 string, status string"

_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The state's code travels with the plan: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _age(entry) -> tuple:
    """Orders entries of a file as ``latest_per_path`` does; NULL is oldest."""
    values = (entry["dt"], entry["landed_at"], entry["landing"], entry["sha256"])
    return tuple((value is not None, value) for value in values)


class _NewestEntry(StatefulProcessor):
    """Keeps the newest entry of a file and reports when its digest is another one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.newest.get()
        old = None if before is None else dict(zip(("dt", "landed_at", "landing", "sha256"), before))
        # Entries are folded one by one, so a file that is landed very often takes no memory.
        newest = None
        for row in rows:
            if newest is None or _age(row) > _age(newest):
                newest = row
        if old is not None and _age(newest) <= _age(old):
            return
        self.newest.update((newest["dt"], newest["landed_at"], newest["landing"], newest["sha256"]))
        if old is None or old["sha256"] != newest["sha256"]:
            yield Row(
                path=key[0],
                kind=newest["kind"],
                dt=newest["dt"],
                landing=newest["landing"],
                sha256=newest["sha256"],
                old_sha256=old and old["sha256"],
                status="changed" if old else "new",
            )

    def close(self) -> None:
        pass


def content_changes(entries: DataFrame) -> DataFrame:
    """The files whose current content is another one than before, at most one row a batch each.

    ``entries``: a stream of manifest entries. An entry older than the newest one known of its
    file changes nothing, whenever it comes; an entry with the digest known moves the date
    and reports nothing. Several entries of a file in one batch count by their outcome.
    """
    # As a number, since a worker would turn a timestamp into its own local time.
    numbered = entries.withColumn("landed_at", F.unix_micros("landed_at"))
    return numbered.groupBy("path").transformWithState(
        _NewestEntry(), CHANGE_SCHEMA, outputMode="append", timeMode="none"
    )


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for a stream started inside; other streams keep their store."""
    before = spark.conf.get(_PROVIDER_CONF, None)
    spark.conf.set(_PROVIDER_CONF, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER_CONF)
        else:
            spark.conf.set(_PROVIDER_CONF, before)


def watch_changes(
    spark: SparkSession,
    bronze: str,
    handle_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Calls ``handle_batch`` with the changes of each batch of the manifest log.

    The checkpoint holds what was read and the state of every file; both move on only when the
    call returns, so a call that failed is made again with the same changes. Without ``every``
    the query ends when the log is read.
    """
    manifest_log(spark, bronze)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    entries = spark.readStream.schema(MANIFEST_SCHEMA).parquet(f"{bronze}/{MANIFEST_LOG}")
    with _rocksdb(spark):
        return (
            content_changes(entries)
            .writeStream.foreachBatch(handle_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def on_change(
    spark: SparkSession,
    bronze: str,
    handle: Callable[[date, list[str]], object],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Calls ``handle`` with the newest date of the log and the kinds of which files changed.

    Not called for compactions, landings of equal files and landings that later ones cover.
    """

    def handle_batch(changes: DataFrame, batch_id: int) -> None:
        kinds = sorted(row.kind for row in changes.groupBy("kind").agg(F.count("*")).collect())
        if kinds:
            # Tables are rebuilt as of this date: a file may have changed for an earlier one.
            newest = manifest_log(spark, bronze).agg(F.max("dt")).first()[0]
            handle(newest, kinds)

    return watch_changes(spark, bronze, handle_batch, checkpoint, every)
