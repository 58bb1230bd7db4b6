"""Micro-batch sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.sources.jdbc import append_jdbc

Writer = Callable[[DataFrame, int], None]

MODES = ("append", "update", "complete")


def start_stream(df: DataFrame, write: Writer, checkpoint: str, output_mode: str = "append",
                 every: str | None = "10 seconds", report: Callable[[int, int], None] | None = None,
                 name: str | None = None, skip_empty: bool = False) -> StreamingQuery:
    """Run `write(batch, batch_id)` for every micro-batch.

    A checkpoint is mandatory: without one a restart would reread or lose data.  `every=None` works
    off all available data and stops.  `report(batch_id, rows)` gets the row count of each batch,
    observed while the batch is written instead of by extra count jobs.  `skip_empty` leaves batches
    without rows unwritten; the batch is kept for that, so that a stateful plan runs once.
    """
    if output_mode not in MODES:
        raise ValueError(f"output mode must be one of {MODES}")
    if not checkpoint:
        raise ValueError("a checkpoint location is required")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if skip_empty:
            batch = batch.persist()
            if batch.isEmpty():
                batch.unpersist()
                if report is not None:
                    report(batch_id, 0)
                return
        try:
            handle(batch, batch_id)
        finally:
            if skip_empty:
                batch.unpersist()

    def handle(batch: DataFrame, batch_id: int) -> None:
        if report is None:
            write(batch, batch_id)
            return
        seen = Observation()
        write(batch.observe(seen, F.count(F.lit(1)).alias("rows")), batch_id)
        report(batch_id, seen.get["rows"])

    writer = (df.writeStream.foreachBatch(on_batch).outputMode(output_mode)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def to_jdbc(batch_column: str | None = None, **settings) -> Writer:
    """Append each micro-batch to a database table.

    An append is repeated when a batch is retried; with `batch_column` every row carries its batch
    id, by which the database can tell repeated rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_column:
            batch = batch.withColumn(batch_column, F.lit(batch_id).cast("bigint"))
        append_jdbc(batch, **settings)

    return write


def wait_for_all(queries: list[StreamingQuery]) -> None:
    """Wait until every query ends.  The first failure of any, or an interrupt, stops the others."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(0.2)  # raises if this one failed
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
