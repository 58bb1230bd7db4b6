"""Referrers, attribution and campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.operators.skew import FLOOR, SHARE, heavy_from_counts, join_in_pieces
from vitrine.plans.measures import is_purchase, ratio, rows

REFERRER_COLUMNS = ["referrer_url", "referrer_host"]
TOUCH_COLUMNS = ["event_id", "device_id", "time_stamp", "collection", "referrer_url"]
CAMPAIGN_COLUMNS = ["device_id", "time_stamp", "collection", "campaign"]
DIRECT = "direct"


def top_referrers(fact: DataFrame, k: int = 5, by: str = "referrer_url") -> DataFrame:
    """The k referrers with most events, by full URL or by host."""
    return (fact.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("referrer"))
            .agg(rows().alias("events")).orderBy(F.desc("events"), "referrer").limit(k))


def touches(fact: DataFrame, share: float = SHARE, floor: int = FLOOR, heavy: DataFrame | None = None) -> DataFrame:
    """Per buying device: first and last referrer at or before its first purchase ("direct" when
    there is none).

    One pass gives each device its first purchase and its number of touches; the touches of a very
    busy device are cut into pieces for the join, and the aggregation combines on the map side.  `heavy`
    (device_id, _pieces) names the busy devices, as stored summaries do (`frequent`); without it the
    touches of buyers are counted for that.
    """
    known = fact.where(F.col("device_id").isNotNull() & F.col("time_stamp").isNotNull())
    buyers = (
        known.groupBy("device_id")
        .agg(F.min(F.when(is_purchase(), F.col("time_stamp"))).alias("bought_at"),
             F.count("referrer_url").alias("n"))
        .where(F.col("bought_at").isNotNull())
    )
    heavy = heavy_from_counts(buyers, "device_id", "n", share, floor) if heavy is None else heavy
    seen = (known.where(F.col("referrer_url").isNotNull())
            .select("device_id", "time_stamp", "event_id", "referrer_url"))
    before = join_in_pieces(seen, buyers.select("device_id", "bought_at"), "device_id", heavy,
                            ["event_id", "time_stamp"]).where(F.col("time_stamp") <= F.col("bought_at"))
    touch = F.struct("time_stamp", "event_id", "referrer_url")
    ends = before.groupBy("device_id").agg(F.min(touch).alias("a"), F.max(touch).alias("b"))
    return (
        buyers.select("device_id").join(ends, "device_id", "left")
        .select("device_id", F.coalesce("a.referrer_url", F.lit(DIRECT)).alias("first_touch"),
                F.coalesce("b.referrer_url", F.lit(DIRECT)).alias("last_touch"))
    )


def attribution(fact: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Conversions credited to each referrer under the first-touch and the last-touch model."""
    credit = F.inline(F.array(
        F.struct(F.lit("first").alias("model"), F.col("first_touch").alias("referrer")),
        F.struct(F.lit("last").alias("model"), F.col("last_touch").alias("referrer"))))
    return touches(fact, heavy=heavy).select(credit).groupBy("model", "referrer").agg(rows().alias("conversions"))


def campaign_effect(fact: DataFrame) -> DataFrame:
    """Per campaign: visits, devices, devices that bought at or after their first campaign visit."""
    known = fact.where(F.col("device_id").isNotNull())
    visits = (known.where(F.col("campaign").isNotNull()).groupBy("campaign", "device_id")
              .agg(rows().alias("visits"), F.min("time_stamp").alias("first_visit")))
    purchases = (known.where(is_purchase()).groupBy("device_id")
                 .agg(F.max("time_stamp").alias("last_purchase")))
    return (
        visits.join(purchases, "device_id", "left").groupBy("campaign")
        .agg(F.sum("visits").alias("visits"), rows().alias("devices"),
             F.count_if(F.col("last_purchase") >= F.col("first_visit")).alias("buyers"))
        .withColumn("conversion", ratio(F.col("buyers"), F.col("devices")))
    )
