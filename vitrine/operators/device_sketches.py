"""Distinct devices over any period, from sketches stored per date, country and store.

A theta sketch keeps the smallest hashes of a set; sketches of parts are united and intersected without
the events.  Up to `2 ** size` devices counts are exact, beyond that within about `2 ** (1 - size / 2)` of the
larger set.  A date's sketches are replaced with the date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.plans.measures import ratio

SIZE = 14


def write_device_sketches(fact: DataFrame, path: str, size: int = SIZE) -> None:
    """One sketch per (date, country, store) of the dates in `fact`, replacing those that are there."""
    (fact.where(F.col("device_id").isNotNull()).groupBy("date_id", "country_code", "store_id")
     .agg(F.theta_sketch_agg("device_id", size).alias("devices"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_id").parquet(path))


def _number(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch).cast("bigint")


def united(sketches: DataFrame, by: list[str], size: int = SIZE) -> DataFrame:
    """One sketch per group of (any dates of) stored sketches."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("devices", size).alias("devices"))


def device_counts(sketches: DataFrame, by: list[str], size: int = SIZE) -> DataFrame:
    return united(sketches, by, size).withColumn("devices", _number(F.col("devices")))


def device_penetration(sketches: DataFrame, size: int = SIZE) -> DataFrame:
    """Devices per country and their share of all devices that were seen in a country."""
    known = united(sketches.where(F.col("country_code").isNotNull()), ["country_code"], size)
    total = _number(F.theta_union_agg("devices", size))
    return (known.withColumn("devices", _number(F.col("devices")))
            .withColumn("penetration", ratio(F.col("devices"), known.agg(total.alias("n")).scalar())))


def country_overlap(sketches: DataFrame, size: int = SIZE) -> DataFrame:
    """Devices seen in both countries of every pair that has any.  Countries are numbered, and each meets
    those behind it by number: the table has a row per country, whatever the number of events."""
    known = united(sketches.where(F.col("country_code").isNotNull()), ["country_code"], size)
    # The window runs over countries; their number is that of the world's domains at most.
    place = F.row_number().over(Window.orderBy("country_code"))
    numbered = known.withColumn("place", place)
    last = numbered.agg(F.max("place")).scalar()
    first = numbered.select(F.col("country_code").alias("country"), F.col("devices").alias("a"),
                            F.explode(F.sequence(F.col("place"), last)).alias("place"))
    both = F.theta_intersection("a", "devices")
    return (first.join(numbered, "place").where(F.col("country") != F.col("country_code"))
            .select("country", F.col("country_code").alias("other_country"), _number(both).alias("devices"))
            .where(F.col("devices") > 0))
