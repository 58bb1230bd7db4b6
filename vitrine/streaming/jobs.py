"""Streaming jobs: the warehouse loader, one query per dimension, and windowed view counts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators.currency import build_dim_currency
from vitrine.operators.customers import build_dim_customer
from vitrine.operators.dates import build_dim_date
from vitrine.operators.devices import build_dim_device
from vitrine.operators.mergeable import TABLES, needed_fields
from vitrine.operators.option_dims import build_dim_alloy_option, build_dim_diamond_option
from vitrine.operators.parse import parse_events
from vitrine.operators.products import build_dim_prd, build_dim_product
from vitrine.operators.quality import audit_rows
from vitrine.plans.measures import is_view, rows
from vitrine.streaming.log import Snapshot
from vitrine.streaming.sinks import Writer, start_stream
from vitrine.streaming.upsert import compact, read_current, run_of, write_tables

# Builder and output mode of the one-query-per-dimension form.
DIMENSIONS = {
    "dim_product": (build_dim_product, "update"),
    "dim_date": (build_dim_date, "append"),
    "dim_currency": (build_dim_currency, "append"),
    "dim_device": (lambda df: build_dim_device(df, distinct=False), "append"),
    "dim_customer": (build_dim_customer, "update"),
    "dim_diamond_option": (build_dim_diamond_option, "update"),
    "dim_prd": (lambda df: build_dim_prd(df, distinct=False), "append"),
    "dim_alloy_option": (build_dim_alloy_option, "update"),
}


def start_dimension_streams(json_stream: DataFrame, writer_for, checkpoint_root: str,
                            names: list[str] | None = None,
                            every: str | None = "10 seconds") -> list[StreamingQuery]:
    """One streaming query per dimension; `writer_for(name)` gives its batch writer."""
    queries = []
    for name in names or list(DIMENSIONS):
        build, mode = DIMENSIONS[name]
        queries.append(start_stream(build(json_stream), writer_for(name),
                                    f"{checkpoint_root}/{name}", mode, every, name=None))
    return queries


def warehouse_writer(root: str, names: list[str], audit: bool = True) -> Writer:
    """Batch writer that parses once and adds the batch's delta to every table, or to none."""
    fields = needed_fields(names)

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        events = parse_events(batch, fields).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if events.isEmpty():
                return

            # The tables are independent, so their small jobs overlap; one entry commits them all.
            tables = {name: TABLES[name].reduce(events) for name in names}
            if audit:
                tables["audit"] = audit_rows(events, "events", batch_id)
            write_tables(tables, root, batch_id, run)
        finally:
            events.unpersist()

    return write


def start_warehouse_stream(json_stream: DataFrame, root: str, checkpoint: str,
                           names: list[str] | None = None,
                           every: str | None = "10 seconds") -> StreamingQuery:
    """One query for all dimensions: the source is read and parsed once per micro-batch."""
    return start_stream(json_stream, warehouse_writer(root, names or list(TABLES)), checkpoint,
                        "append", every)


def read_table(spark: SparkSession, root: str, name: str, seen: Snapshot | None = None) -> DataFrame:
    """A table as it is now, or as it was when `seen` was taken: tables read from one snapshot belong together."""
    table = TABLES[name]
    return table.finish(read_current(spark, root, table.combine, name, seen))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return read_current(spark, root, lambda stored: stored, "audit")


def compact_table(spark: SparkSession, root: str, name: str) -> int:
    return compact(spark, root, TABLES[name].combine, name)


def windowed_views(events: DataFrame, size: str, slide: str | None = None,
                   by: list[str] | None = None, delay: str = "10 minutes") -> DataFrame:
    """Views per tumbling (or, with `slide`, sliding) event-time window.

    The window is a grouping key, so the watermark bounds state: windows older than the newest
    event minus `delay` are emitted in append mode and forgotten.
    """
    window = F.window("time_stamp", size, slide)
    by = by or []
    return (
        events.where(is_view()).withWatermark("time_stamp", delay)
        .groupBy(window.alias("w"), *by).agg(rows().alias("views"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "views")
    )


def device_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Visits of a device: events no more than `gap` apart."""
    return (
        events.where(F.col("device_id").isNotNull()).withWatermark("time_stamp", delay)
        .groupBy(F.session_window("time_stamp", gap).alias("w"), "device_id")
        .agg(rows().alias("events"))
        .select("device_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                "events")
    )


def view_parts(events: DataFrame, size: str, slide: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Views of some events per window: a part that `whole_windows` adds to others.  Nothing waits for a
    watermark, so open windows and late events count as well."""
    window = F.window("time_stamp", size, slide)
    return (
        events.where(is_view()).groupBy(window.alias("w"), *(by or []))
        .agg(rows().alias("views"), F.max("time_stamp").alias("newest"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *(by or []),
                "views", "newest")
    )


def _closed(end: str, parts: DataFrame, delay: str) -> Column:
    """Whether the end lies before the newest event less `delay`."""
    newest = parts.agg(F.max("newest").alias("t")).scalar()
    return F.col(end) <= newest - F.expr(f"INTERVAL {delay}")


def whole_windows(parts: DataFrame, by: list[str] | None = None, delay: str = "10 minutes") -> DataFrame:
    """All windows with their views; `closed` tells those that no event within `delay` can change."""
    keys = ["window_start", "window_end", *(by or [])]
    return (parts.groupBy(*keys).agg(F.sum("views").alias("views"))
            .withColumn("closed", _closed("window_end", parts, delay)))


def _seconds(length: str) -> Column:
    """Seconds of an interval without months, e.g. "30 minutes"."""
    return F.unix_seconds(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {length}"))


def session_parts(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Events of a device per time slice of one gap's length: a part that `whole_sessions` joins to others.
    Events of a slice are less than a gap apart, so they belong together and nothing is ordered."""
    known = events.where(F.col("device_id").isNotNull() & F.col("time_stamp").isNotNull())
    slice_ = F.floor(F.unix_seconds("time_stamp") / _seconds(gap)).alias("slice")
    return (
        known.groupBy("device_id", slice_)
        .agg(F.min("time_stamp").alias("session_start"), F.max("time_stamp").alias("newest"), rows().alias("events"))
        .select("device_id", "slice", "session_start", (F.col("newest") + F.expr(f"INTERVAL {gap}")).alias("session_end"),
                "events", "newest")
    )


def whole_sessions(parts: DataFrame, delay: str = "10 minutes", block: int = 1000) -> DataFrame:
    """Visits of all parts: those of a device that overlap become one.

    A slice lasts as long as the gap, so only the slice right before can reach into it: whether a
    visit begins in a slice is an aggregation.  Which visit a slice belongs to is the last beginning at
    or before it, found within blocks of `block` slices and carried over from block to block, so a
    device that never rests is as many small tasks as it has blocks.
    """
    slices = parts.groupBy("device_id", "slice").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.sum("events").alias("events"))
    # Every slice tells the next one where it ends.
    told = F.inline(F.array(
        F.struct("slice", "session_start", "session_end", "events", F.lit(None).cast("timestamp").alias("reach")),
        F.struct((F.col("slice") + 1).alias("slice"), F.lit(None).cast("timestamp").alias("session_start"),
                 F.lit(None).cast("timestamp").alias("session_end"), F.lit(None).cast("bigint").alias("events"),
                 F.col("session_end").alias("reach"))))
    placed = (slices.select("device_id", told).groupBy("device_id", "slice")
              .agg(*[F.max(c).alias(c) for c in ("session_start", "session_end", "events", "reach")])
              .where(F.col("session_start").isNotNull())
              .withColumn("block", F.floor(F.col("slice") / block)))
    begins = F.when(F.col("reach").isNull() | (F.col("session_start") >= F.col("reach")), F.col("session_start"))
    inside = Window.partitionBy("device_id", "block").orderBy("slice")
    visits = placed.withColumn("visit", F.max(begins).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy("device_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (visits.groupBy("device_id", "block").agg(F.max("visit").alias("last"))
               .select("device_id", "block", F.max("last").over(before).alias("carried")))
    return (visits.join(carried, ["device_id", "block"])
            .groupBy("device_id", F.coalesce("visit", "carried").alias("session_start"))
            .agg(F.max("session_end").alias("session_end"), F.sum("events").alias("events"))
            .withColumn("closed", _closed("session_end", parts, delay)))


def first_events(events: DataFrame, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """Stateful duplicate removal whose state expires with the watermark."""
    return events.withWatermark("time_stamp", delay).dropDuplicatesWithinWatermark(keys)
