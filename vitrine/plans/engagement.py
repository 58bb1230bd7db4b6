"""View duration and preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.operators.skew import neighbour
from vitrine.plans.measures import is_view, ratio, rows


def view_durations(fact: DataFrame, cap_ms: int | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """All views with `view_ms`: time to the next event of the same device, NULL where none follows or
    device or time are unknown.  With `cap_ms`, longer gaps mean the visitor left and give NULL too."""
    known = fact.where(F.col("device_id").isNotNull() & F.col("time_stamp").isNotNull())
    timed = neighbour(known, "device_id", "time_stamp", ["event_id"],
                      {"ms": F.unix_millis("time_stamp")}, step=1, into="next", heavy=heavy)
    gap = F.col("next.ms") - F.unix_millis("time_stamp")
    known = timed.where(is_view()).withColumn("view_ms", gap if cap_ms is None else F.when(gap <= cap_ms, gap))
    unknown = fact.where(is_view() & (F.col("device_id").isNull() | F.col("time_stamp").isNull()))
    return known.drop("next").unionByName(unknown.withColumn("view_ms", F.lit(None).cast("bigint")))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Join on null-safe equality of columns of the same names, of which the left ones stay."""
    right = right.withColumnsRenamed({name: f"_{name}" for name in names})
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return left.join(right, same).drop(*[f"_{name}" for name in names])


def duration_stats(views: DataFrame, by: list[str], approximate: bool = False) -> DataFrame:
    """Per group: all views, those with a duration (`timed_views`) and without (`open_views`), and total,
    mean and median of the durations.  `approximate` takes the median from a mergeable sketch.

    Everything exact comes from one histogram of the views (group, view_ms).  Its minutes give the sums and
    show in which minute the middle values lie; only those minutes are ordered by value, so no task
    orders more than the minutes of a group or the values of a minute.
    """
    columns = ["views", "timed_views", "open_views", "total_ms", "mean_ms", "median_ms"]
    if approximate:
        counted = views.groupBy(*by).agg(
            rows().alias("views"), F.count("view_ms").alias("timed_views"),
            F.count_if(F.col("view_ms").isNull()).alias("open_views"), F.sum("view_ms").alias("total_ms"),
            F.percentile_approx("view_ms", 0.5, 10000).cast("double").alias("median_ms"))
        return counted.withColumn("mean_ms", ratio(F.col("total_ms"), F.col("timed_views"))).select(*by, *columns)
    minute = F.floor(F.col("view_ms") / 60_000).alias("minute")
    histogram = views.groupBy(*by, minute, "view_ms").agg(rows().alias("n"))
    known = F.col("minute").isNotNull()
    minutes = histogram.groupBy(*by, "minute").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("view_ms")).alias("ms"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = F.when(known, F.col("m"))
    placed = minutes.withColumns({
        "views": F.sum("m").over(group), "timed_views": F.coalesce(F.sum(timed).over(group), F.lit(0)),
        "total_ms": F.sum("ms").over(group), "before": F.sum(timed).over(upto) - F.col("m")})
    # The middle values have the places (timed + 1) // 2 and timed // 2 + 1, from 1; a group without any
    # keeps its only row.
    low, high = F.floor((F.col("timed_views") + 1) / 2), F.floor(F.col("timed_views") / 2) + 1
    middle = (F.col("timed_views") == 0) | (known & (F.col("before") < high) & (F.col("before") + F.col("m") >= low))
    inside = Window.partitionBy(*by, "minute").orderBy("view_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = (_same(histogram, placed.where(middle).drop("m", "ms"), [*by, "minute"])
              .withColumn("upto", F.col("before") + F.sum("n").over(inside)))
    ends = [F.min(F.when(F.col("upto") >= place, F.col("view_ms"))) for place in (low, high)]
    return (values.groupBy(*by)
            .agg(*[F.max(c).alias(c) for c in ("views", "timed_views", "total_ms")],
                 ((ends[0] + ends[1]) / 2.0).cast("double").alias("median_ms"))
            .withColumns({"open_views": F.col("views") - F.col("timed_views"),
                          "mean_ms": ratio(F.col("total_ms"), F.col("timed_views"))}).select(*by, *columns))


def duration_by_product_country(views: DataFrame, approximate: bool = False) -> DataFrame:
    """`views` here and below: from `view_durations`, or from the stored timeline (`timeline_views`)."""
    return duration_stats(views, ["product_id", "country_code"], approximate)


def duration_by_customising(views: DataFrame, approximate: bool = False) -> DataFrame:
    """Time on page with and without chosen options."""
    return duration_stats(views, ["has_option"], approximate)


def duration_by_option(views: DataFrame, approximate: bool = False) -> DataFrame:
    """Time on page per chosen diamond and per chosen alloy."""
    choice = F.inline(F.array(
        F.struct(F.lit("diamond").alias("option_label"), F.col("diamond_option_id").alias("option_id")),
        F.struct(F.lit("alloy").alias("option_label"), F.col("alloy_option_id").alias("option_id"))))
    chosen = views.select("view_ms", choice).where(F.col("option_id").isNotNull())
    return duration_stats(chosen, ["option_label", "option_id"], approximate)


def country_preference(fact: DataFrame, k: int = 3) -> DataFrame:
    """The k most viewed products of each country.  Filtering on row_number lets Spark cut each
    country to k rows before the shuffle as well."""
    views = (fact.where(is_view() & F.col("country_code").isNotNull() & F.col("product_id").isNotNull())
             .groupBy("country_code", "product_id").agg(rows().alias("views")))
    place = F.row_number().over(
        Window.partitionBy("country_code").orderBy(F.desc("views"), "product_id"))
    return views.withColumn("place", place).where(F.col("place") <= k)
