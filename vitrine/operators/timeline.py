"""Next events of devices, kept beside the fact table.

Which event follows an event of a device is settled when a date is loaded, except for the device's last
event of the date.  The timeline stores, per date,

* every view whose next event is known, with the time of that event;
* one tail row per device and slice: the slice's last event and the time of its first one.

A slice is a date, or one minute for a device that holds a large part of its date (`frequent`), so
no task orders more than a share of a date.  A query reads views as they are and orders tails only: one
row per device and day instead of all events.  Adding a date changes no other date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vitrine.operators.frequent import write_frequent_keys
from vitrine.operators.skew import FLOOR, SHARE
from vitrine.plans.measures import is_view

TIMELINE_COLUMNS = ["event_id", "device_id", "time_stamp", "collection", "product_id", "country_code",
                    "has_option", "diamond_option_id", "alloy_option_id"]
# More minutes than a day of 25 hours has.
DAY = 1600


def _minute(time: Column) -> Column:
    """Minutes since the day began."""
    return F.floor((F.unix_seconds(time) - F.unix_seconds(F.date_trunc("day", time))) / 60)


def timeline_rows(fact: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Rows of the timeline for whole dates of `fact`; `heavy` (date_id, device_id) are cut into minutes.

    `slice` orders a device's slices, `next_at` is the time of the next event in the slice (NULL in tails
    and where device or time are unknown), `first_at` (tails only) that of the slice's first event.
    """
    rows = fact.select("date_id", *TIMELINE_COLUMNS)
    known = F.col("device_id").isNotNull() & F.col("time_stamp").isNotNull()
    day = F.unix_date(F.to_date("time_stamp")).cast("bigint") * DAY
    cut = rows.where(known)
    if heavy is not None:
        hot = F.broadcast(heavy.select("date_id", "device_id", F.lit(True).alias("_hot")))
        minute = F.when(F.col("_hot"), _minute(F.col("time_stamp"))).otherwise(0)
        cut = cut.join(hot, ["date_id", "device_id"], "left").withColumn("slice", day + minute).drop("_hot")
    else:
        cut = cut.withColumn("slice", day)
    order = Window.partitionBy("device_id", "slice").orderBy("time_stamp", "event_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut.withColumns({
        "next_at": F.lead("time_stamp").over(order), "_first": F.first("time_stamp").over(so_far)})
    placed = placed.withColumn("tail", F.col("next_at").isNull())
    placed = placed.withColumn("first_at", F.when(F.col("tail"), F.col("_first"))).drop("_first")
    unknown = rows.where(~known & is_view()).withColumn("tail", F.lit(False))
    return placed.where(F.col("tail") | is_view()).unionByName(unknown, allowMissingColumns=True)


def heavy_devices(summaries: DataFrame, share: float = SHARE, floor: int = FLOOR) -> DataFrame:
    """(date_id, device_id) of devices that hold more than `share` of a date and `floor` rows."""
    of = summaries.where(F.col("key_name") == "device_id")
    whole = of.where(F.col("key").isNull()).select("date_id", F.col("n").alias("total"))
    return (of.where(F.col("key").isNotNull() & (F.col("n") > floor)).join(F.broadcast(whole), "date_id")
            .where(F.col("n") > F.col("total") * share).select("date_id", F.col("key").alias("device_id")))


def refresh_timeline(fact: DataFrame, root: str, dates: list[int] | None = None, share: float = SHARE,
                     floor: int = FLOOR) -> None:
    """Bring `<root>/timeline` and `<root>/key_summary` up to date for `dates` (default: all) of the stored
    fact table.  A date is replaced whole: late events of a date need its refresh, and only its."""
    rows = fact if dates is None else fact.where(F.col("date_id").isin(dates))
    write_frequent_keys(rows, ["device_id", "product_id"], f"{root}/key_summary")
    spark = fact.sparkSession
    heavy = heavy_devices(read_key_summary(spark, root), share, floor)
    if dates is not None:
        heavy = heavy.where(F.col("date_id").isin(dates))
    # Tails apart within files, so that their groups of rows are skipped by those who want views.
    (timeline_rows(rows, heavy).hint("rebalance", "date_id").sortWithinPartitions("date_id", "tail")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_id")
     .parquet(f"{root}/timeline"))


def read_timeline(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/timeline")


def read_key_summary(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/key_summary")


def timeline_views(timeline: DataFrame, cap_ms: int | None = None) -> DataFrame:
    """All views with `view_ms`, as `engagement.view_durations` gives them for the whole fact table."""
    start = F.unix_millis("time_stamp")
    inner = (timeline.where(is_view() & ~F.col("tail"))
             .withColumn("view_ms", F.unix_millis("next_at") - start))
    after = F.lead("first_at").over(Window.partitionBy("device_id").orderBy("slice"))
    tails = (timeline.where(F.col("tail")).withColumn("view_ms", F.unix_millis(after) - start)
             .where(is_view()))
    views = inner.unionByName(tails).drop("date_id", "slice", "next_at", "first_at", "tail")
    return views if cap_ms is None else views.withColumn(
        "view_ms", F.when(F.col("view_ms") <= cap_ms, F.col("view_ms")))
