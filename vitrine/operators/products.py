"""Product dimensions built from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.options import has_options, option_id
from vitrine.functions.text import filled, or_sentinel
from vitrine.operators.parse import parse_events

# The two customisation labels; matching is exact and case-sensitive.
DIAMOND = "diamond"
ALLOY = "alloy"

PRODUCT_FIELDS = ["_id", "time_stamp", "collection", "product_id", "option"]


def event_order(*tie: Column) -> list[Column]:
    """Sort key "earliest event first", rows without a time last."""
    return [F.col("time_stamp").isNull().alias("late"), F.col("time_stamp").alias("at"),
            F.col("_id").alias("id"), *tie]


def product_rows(events: DataFrame, keep_optionless: bool = False) -> DataFrame:
    """One row per event with its first diamond and alloy option id.

    Option ids are read from the array in place, so a row is never multiplied before the
    aggregation.  Events without options are left out unless `keep_optionless`.
    """
    rows = events if keep_optionless else events.where(has_options(F.col("option")))
    return rows.select("product_id", "collection", "time_stamp", "_id",
                       option_id(F.col("option"), DIAMOND).alias("diamond"),
                       option_id(F.col("option"), ALLOY).alias("alloy"))


def earliest(value: Column) -> Column:
    """Value of the earliest event in which it is not NULL; ties end at the value itself, so the
    survivor never depends on how rows are partitioned."""
    key = F.struct(*event_order(value.alias("value")))
    return F.min(F.when(value.isNotNull(), key))["value"]


def product_options(events: DataFrame, keep_optionless: bool = False) -> DataFrame:
    """One row per (product_id, collection) with the earliest diamond and alloy option id."""
    return (
        product_rows(events, keep_optionless).groupBy("product_id", "collection")
        .agg(earliest(F.col("diamond")).alias("diamond"), earliest(F.col("alloy")).alias("alloy"))
        .select("product_id", "collection",
                or_sentinel(F.col("diamond")).alias("diamond_option_id"),
                or_sentinel(F.col("alloy")).alias("alloy_option_id"))
    )


def build_dim_product(json_df: DataFrame, keep_optionless: bool = False) -> DataFrame:
    return product_options(parse_events(json_df, PRODUCT_FIELDS), keep_optionless)


def build_dim_prd(json_df: DataFrame, distinct: bool = True, last_seen: bool = False) -> DataFrame:
    """(product_id, current_url) pairs.

    `distinct=False` keeps one row per event; `last_seen` adds the newest event time of each pair,
    which lets the merge prefer the page seen last.
    """
    if last_seen:
        events = parse_events(json_df, ["product_id", "current_url", "time_stamp"])
        return events.groupBy("product_id", "current_url").agg(F.max("time_stamp").alias("last_seen"))
    pairs = parse_events(json_df, ["product_id", "current_url"])
    return pairs.distinct() if distinct else pairs


def crawl_worklist(dim_prd: DataFrame, product_info: DataFrame | None = None) -> DataFrame:
    """Distinct (product_id, current_url) still to fetch, ordered by product.

    Pages already in `product_info` are left out, so a rerun adds nothing twice.
    """
    todo = (dim_prd.where(filled(F.col("current_url")))
            .select("product_id", "current_url").distinct())
    if product_info is not None:
        # Reruns may have stored a page many times; one row per page is enough to exclude it.
        todo = todo.join(product_info.select("current_url").distinct(), "current_url", "left_anti")
    return todo.select("product_id", "current_url").orderBy("product_id", "current_url")
