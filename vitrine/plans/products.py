"""Product performance.  All functions take the event fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.plans.measures import is_purchase, is_view, ratio, rows

TOP_PRODUCTS_COLUMNS = ["collection", "product_id"]
DAILY_COLUMNS = ["collection", "product_id", "event_date"]
FUNNEL_COLUMNS = ["collection", "product_id", "device_id", "time_stamp"]
PAIR_COLUMNS = ["diamond_option_id", "alloy_option_id"]


def top_products(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k products with most views; ties go to the smaller product_id."""
    return (fact.where(is_view() & F.col("product_id").isNotNull())
            .groupBy("product_id").agg(rows().alias("views"))
            .orderBy(F.desc("views"), "product_id").limit(k))


def daily_views(fact: DataFrame, k: int = 10, days: int = 7) -> DataFrame:
    """Views per day of the top k products on a dense calendar (first to last view day of the
    product), with the moving mean over `days` days.

    The top list has k rows, which bounds the broadcast.  Windows run over daily counts of k
    products only.
    """
    per_day = (
        fact.where(is_view() & F.col("event_date").isNotNull())
        .join(F.broadcast(top_products(fact, k).select("product_id")), "product_id", "left_semi")
        .groupBy("product_id", "event_date").agg(rows().alias("views"))
    )
    calendar = (per_day.groupBy("product_id")
                .agg(F.min("event_date").alias("a"), F.max("event_date").alias("b"))
                .select("product_id", F.explode(F.sequence("a", "b")).alias("event_date")))
    window = Window.partitionBy("product_id").orderBy("event_date").rowsBetween(1 - days, 0)
    return (
        calendar.join(per_day, ["product_id", "event_date"], "left")
        .withColumn("views", F.coalesce("views", F.lit(0)))
        .withColumn("moving_mean", F.avg("views").over(window))
    )


def product_funnel(fact: DataFrame) -> DataFrame:
    """Per product: views, devices that viewed it, devices that bought it at or after their first
    view, and the rate.  First reduced to (product, device), then to products: both steps combine
    on the map side."""
    per_device = (
        fact.where(F.col("product_id").isNotNull() & F.col("device_id").isNotNull())
        .groupBy("product_id", "device_id")
        .agg(F.count_if(is_view()).alias("views"),
             F.min(F.when(is_view(), F.col("time_stamp"))).alias("first_view"),
             F.max(F.when(is_purchase(), F.col("time_stamp"))).alias("last_purchase"))
        .where(F.col("views") > 0)
    )
    bought = F.col("last_purchase") >= F.col("first_view")
    return (
        per_device.groupBy("product_id")
        .agg(F.sum("views").alias("views"), rows().alias("viewers"), F.count_if(bought).alias("buyers"))
        .withColumn("conversion", ratio(F.col("buyers"), F.col("viewers")))
    )


def option_pairs(fact: DataFrame, k: int | None = None) -> DataFrame:
    """How often each diamond and alloy were chosen together."""
    pairs = (fact.where(F.col("diamond_option_id").isNotNull() & F.col("alloy_option_id").isNotNull())
             .groupBy("diamond_option_id", "alloy_option_id").agg(rows().alias("events")))
    if k is None:
        return pairs
    return pairs.orderBy(F.desc("events"), "diamond_option_id", "alloy_option_id").limit(k)
