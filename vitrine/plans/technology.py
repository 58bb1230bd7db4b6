"""Browsers, systems, device types, and customer segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.user_agents import classify
from vitrine.operators.skew import even_bands
from vitrine.plans.measures import grand_total, ratio, rows

TECH_COLUMNS = ["user_agent"]
SEGMENT_COLUMNS = ["customer"]


def tech_stats(fact: DataFrame, rules: str = "reference") -> DataFrame:
    """Events and share per (browser, system, device type).  Events are counted per user agent
    before any pattern runs, so each distinct agent is classified once."""
    agents = fact.groupBy("user_agent").agg(rows().alias("n"))
    parts = classify(F.col("user_agent"), rules)
    by = ["browser", "system", "device_type"]
    table = agents.select(*[parts[c].alias(c) for c in by], "n").groupBy(*by).agg(F.sum("n").alias("events"))
    return table.withColumn("share", ratio(F.col("events"), grand_total(table, "events")))


def customer_segments(fact: DataFrame, bands: int = 4) -> DataFrame:
    """Activity band of each customer: 1 for the least active quarter, 4 for the most active."""
    activity = (fact.where(F.col("customer").isNotNull())
                .groupBy("customer").agg(rows().alias("events")))
    return even_bands(activity, "events", "customer", bands, into="band")
