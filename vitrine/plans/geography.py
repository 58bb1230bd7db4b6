"""Countries and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.plans.measures import grand_total, is_purchase, is_view, ratio, rows

COUNTRY_COLUMNS = ["country_code"]
BORDER_COLUMNS = ["country_code", "device_id"]
STORE_COLUMNS = ["country_code", "store_id", "device_id", "collection"]


def top_countries(fact: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with most events and their share of all events that have a country."""
    counts = (fact.where(F.col("country_code").isNotNull())
              .groupBy("country_code").agg(rows().alias("events")))
    return (counts.withColumn("share", ratio(F.col("events"), grand_total(counts, "events")))
            .orderBy(F.desc("events"), "country_code").limit(k))


def cross_border(fact: DataFrame) -> DataFrame:
    """Devices seen in two or more countries, by (home, visited) pair with their events abroad.

    Home is the country in which the device has most events (ties: alphabetical).  Pairing home
    with each other country keeps the output linear in the (device, country) rows; the window
    runs over those reduced rows, one per country of a device.
    """
    seen = (fact.where(F.col("country_code").isNotNull() & F.col("device_id").isNotNull())
            .groupBy("device_id", "country_code").agg(rows().alias("n")))
    order = Window.partitionBy("device_id").orderBy(F.desc("n"), "country_code")
    home = F.first("country_code").over(order)
    return (
        seen.withColumn("home_country", home)
        .where(F.col("home_country") != F.col("country_code"))
        .groupBy("home_country", F.col("country_code").alias("visited_country"))
        .agg(rows().alias("devices"), F.sum("n").alias("events_abroad"))
    )


def penetration(fact: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct devices per country over all distinct devices.

    Exact counts reduce to (country, device) first.  `approximate` uses mergeable sketches and
    needs no shuffle of devices.
    """
    seen = fact.where(F.col("country_code").isNotNull() & F.col("device_id").isNotNull())
    if approximate:
        devices = F.approx_count_distinct("device_id")
        counts = seen.groupBy("country_code").agg(devices.alias("devices"))
        total = seen.agg(devices.alias("total")).scalar()
    else:
        pairs = seen.select("country_code", "device_id").distinct()
        counts = pairs.groupBy("country_code").agg(rows().alias("devices"))
        total = pairs.select("device_id").distinct().agg(rows().alias("total")).scalar()
    return counts.withColumn("penetration", ratio(F.col("devices"), total))


def store_comparison(fact: DataFrame) -> DataFrame:
    """Views, purchases and distinct devices per (country, store)."""
    per_device = (
        fact.where(F.col("store_id").isNotNull())
        .groupBy("country_code", "store_id", "device_id")
        .agg(F.count_if(is_view()).alias("views"), F.count_if(is_purchase()).alias("purchases"))
    )
    return per_device.groupBy("country_code", "store_id").agg(
        F.sum("views").alias("views"), F.count("device_id").alias("devices"),
        F.sum("purchases").alias("purchases"))


def store_rank(fact: DataFrame) -> DataFrame:
    """Rank of each store by views inside its country; the window sees one row per store."""
    views = (fact.where(is_view() & F.col("store_id").isNotNull())
             .groupBy("country_code", "store_id").agg(rows().alias("views")))
    place = F.rank().over(Window.partitionBy("country_code").orderBy(F.desc("views")))
    return views.withColumn("place", place)


def regional_cube(fact: DataFrame) -> DataFrame:
    """Events over every grouping of country, store and collection.

    Counted at the finest grain first: the cube then multiplies those few rows by eight, not the
    events.  `level` is the grouping id, which tells a NULL value from a total.
    """
    fine = fact.groupBy("country_code", "store_id", "collection").agg(rows().alias("n"))
    return fine.cube("country_code", "store_id", "collection").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("events"))
