"""Option dimensions (diamond, alloy, or any other label)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.operators.parse import parse_events
from vitrine.operators.products import ALLOY, DIAMOND, event_order

OPTION_FIELDS = ["_id", "time_stamp", "option"]


def option_rows(events: DataFrame, label: str) -> DataFrame:
    """One row per option entry with this label; the array is filtered before it is exploded."""
    entries = F.filter("option", lambda o: o["option_label"] == label)
    return (
        events.select(*[c for c in ("time_stamp", "_id") if c in events.columns],
                      F.posexplode(entries).alias("pos", "entry"))
        .select("*", F.col("entry.option_label").alias("optionLabel"),
                F.col("entry.option_id").alias("optionId"),
                F.col("entry.value_label").alias("valueLabel"),
                F.col("entry.value_id").alias("valueId"))
        .drop("entry")
    )


def option_dim(events: DataFrame, label: str, key: str = "option") -> DataFrame:
    """`key="option"`: one row per (optionLabel, optionId), its value taken from the earliest event.
    `key="value"`: every distinct (optionId, valueLabel, valueId) of the label."""
    rows = option_rows(events, label)
    if key == "value":
        return rows.select("optionLabel", "optionId", "valueLabel", "valueId").distinct()
    if key != "option":
        raise ValueError(f"unknown key {key!r}")
    survivor = F.struct(*event_order(F.col("pos"), F.col("valueLabel"), F.col("valueId")))
    return (
        rows.groupBy("optionLabel", "optionId").agg(F.min(survivor).alias("s"))
        .select("optionLabel", "optionId", F.col("s.valueLabel").alias("valueLabel"),
                F.col("s.valueId").alias("valueId"))
    )


def build_option_dim(json_df: DataFrame, label: str, key: str = "option") -> DataFrame:
    fields = ["option"] if key == "value" else OPTION_FIELDS
    return option_dim(parse_events(json_df, fields), label, key)


def build_dim_diamond_option(json_df: DataFrame, key: str = "option") -> DataFrame:
    return build_option_dim(json_df, DIAMOND, key)


def build_dim_alloy_option(json_df: DataFrame, key: str = "option") -> DataFrame:
    return build_option_dim(json_df, ALLOY, key)
