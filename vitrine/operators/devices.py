"""Device dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.user_agents import classify
from vitrine.operators.parse import parse_events
from vitrine.schemas import DIM_DEVICE


def device_attributes(events: DataFrame, rules: str = "reference",
                      keep: list[str] | None = None) -> DataFrame:
    """Device columns in their declared types; `keep` carries further input columns along."""
    columns = {"device_id": F.col("device_id"), **classify(F.col("user_agent"), rules)}
    return events.select(*(keep or []), *[
        columns[f.name].cast(f.dataType).alias(f.name) for f in DIM_DEVICE.fields])


def build_dim_device(json_df: DataFrame, rules: str = "reference", distinct: bool = True) -> DataFrame:
    """`distinct=False` gives one row per event.  Otherwise (device, agent) pairs are made distinct
    before any pattern runs, and again afterwards because two agents may classify alike."""
    events = parse_events(json_df, ["device_id", "user_agent"])
    if not distinct:
        return device_attributes(events, rules)
    return device_attributes(events.distinct(), rules).distinct()
