"""Runs the transform when something was landed.

Landings append to an event log. Reading that log as a stream keeps track of which
events were handled, across restarts, in the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtledger.sources.landing import EVENT_LOG, EVENT_SCHEMA


def on_landing(
    spark: SparkSession,
    bronze: str,
    handle: Callable[[date], object],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Calls ``handle`` with the newest landing date of the events not handled yet.

    One call covers several waiting events: the tables are rebuilt from every landing
    up to a date. Without ``every`` the query ends when the waiting events are handled;
    with it (``"1 hour"``) it keeps looking.
    """

    def handle_batch(events: DataFrame, batch_id: int) -> None:
        newest = events.agg(F.max("dt")).first()[0]
        if newest is not None:
            handle(newest)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .parquet(f"{bronze}/{EVENT_LOG}")
        .writeStream.foreachBatch(handle_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
