"""Continuous form of the increments, and deduplication of a stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sedimenta.plans.warehouse import Warehouse
from sedimenta.sources.landing import read_landed


def stream_increments(
    warehouse: Warehouse,
    path: str,
    checkpoint: str,
    name: str = "increments",
    layout: str = "landed",
    files_per_batch: int = 1000,
    every: str | None = None,
) -> StreamingQuery:
    """Run every new group of landed files as one increment.

    The checkpoint decides which files are new. Each micro-batch is keyed by its
    number in the load log, so a batch that is delivered again after a failure
    continues at its first uncommitted step. A backlog may hold many months, so each
    month's rows are gathered before they are written. Increments go by load, not by mark:
    a file that arrives late is loaded all the same. Without `every`, the stream
    stops when all present files are loaded. Call warehouse.refresh() before
    reading the tables: the batches run in a session of their own.
    """
    options = replace(warehouse.options, by_load=True)
    store = warehouse.store
    documents = read_landed(
        warehouse.spark, path, layout, stream=True, files_per_batch=files_per_batch
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        own = Warehouse(batch.sparkSession, store.root, store.prefix, options)
        own.run(batch, batch_key=f"{name} {batch_id}", many_months=True)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        documents.writeStream.foreachBatch(load)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def dedupe_stream(
    readings: DataFrame, keys: Sequence[str], event_time: str, lateness: str
) -> DataFrame:
    """First copy of each reading whose copies lie within `lateness`.

    State is dropped once the watermark has passed, so it does not grow with the
    stream. Watermarks need a TIMESTAMP; the column is left as it is in the result.
    """
    timed = readings.withColumn("_event", F.col(event_time).cast("timestamp"))
    unique = timed.withWatermark("_event", lateness).dropDuplicatesWithinWatermark(list(keys))
    return unique.drop("_event")
