"""Event fact table, store dimension and the star join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.keys import surrogate_key
from vitrine.functions.options import has_options, option_id
from vitrine.functions.text import blank_to_null, filled
from vitrine.functions.times import date_id
from vitrine.functions.urls import url_country, url_host, url_parameter
from vitrine.operators.customers import customer_key_columns
from vitrine.operators.parse import parse_events
from vitrine.operators.products import ALLOY, DIAMOND

# Helper column of `fact_event`.
COUNTRY = "_country"


def customer_key() -> Column:
    user, mail = customer_key_columns()
    known = filled(user) | filled(mail)
    return F.when(known, surrogate_key(user, mail))


def fact_columns() -> dict[str, tuple[list[str], Column]]:
    """Output column -> (event fields it reads, expression)."""
    col = F.col
    return {
        "event_id": (["_id"], col("_id")),
        "time_stamp": (["time_stamp"], col("time_stamp")),
        "event_date": (["time_stamp"], F.to_date("time_stamp")),
        "date_id": (["time_stamp"], date_id(F.to_date("time_stamp"))),
        "collection": (["collection"], col("collection")),
        "product_id": (["product_id"], col("product_id")),
        "product_key": (["product_id", "collection"],
                        surrogate_key(col("product_id"), col("collection"))),
        "device_id": (["device_id"], col("device_id")),
        "device_key": (["device_id", "user_agent"],
                       surrogate_key(col("device_id"), col("user_agent"))),
        "user_agent": (["user_agent"], col("user_agent")),
        "customer_key": (["user_id_db", "email_address"], customer_key()),
        "customer": (["user_id_db", "email_address"],
                     F.coalesce(*[blank_to_null(c) for c in customer_key_columns()])),
        "store_id": (["store_id"], col("store_id")),
        "country_code": (["current_url"], url_country(col("current_url"))),
        "store_key": (["store_id", "current_url"], surrogate_key(col("store_id"), col(COUNTRY))),
        "current_url": (["current_url"], col("current_url")),
        "campaign": (["current_url"], url_parameter(col("current_url"), "utm_campaign")),
        "referrer_url": (["referrer_url"], blank_to_null(col("referrer_url"))),
        "referrer_host": (["referrer_url"], url_host(col("referrer_url"))),
        "has_option": (["option"], has_options(col("option"))),
        "diamond_option_id": (["option"], option_id(col("option"), DIAMOND)),
        "alloy_option_id": (["option"], option_id(col("option"), ALLOY)),
        "raw_currency": (["currency"], blank_to_null(col("currency"))),
        "ip": (["ip"], col("ip")),
        "resolution": (["resolution"], col("resolution")),
        "api_version": (["api_version"], col("api_version")),
        "local_time": (["local_time"], col("local_time")),
    }


def fact_event(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per event: natural and surrogate keys plus the derived attributes.

    A projection: no join and no shuffle, whatever the number of dimensions.
    """
    made = {c: expression for c, (_, expression) in fact_columns().items()}
    if "current_url" in events.columns:
        # A key names its parts several times: the country is found once per event, below it.
        events = events.withColumn(COUNTRY, made["country_code"])
        made["country_code"] = F.col(COUNTRY)
    return events.select([made[c].alias(c) for c in (columns or list(made))])


def build_fact_event(json_df: DataFrame, columns: list[str] | None = None,
                     time_mode: str = "normalised") -> DataFrame:
    """Parse only the event fields that the requested fact columns read."""
    table = fact_columns()
    wanted = columns or list(table)
    fields = sorted({field for c in wanted for field in table[c][0]})
    return fact_event(parse_events(json_df, fields, time_mode), wanted)


def write_fact(fact: DataFrame, path: str, mode: str = "append", rebalance: bool = True) -> None:
    """Parquet partitioned by date.

    The rebalance hint groups rows by date so that a task writes few files, and lets AQE split a
    date that holds most of the rows into parts of the advisory size.  Input that arrives in time
    order does without (`rebalance=False`), which saves the shuffle.  `mode="overwrite"` replaces
    only the dates that occur in `fact`, so reloading a whole date is repeatable.
    """
    if rebalance:
        fact = fact.hint("rebalance", "date_id")
    (fact.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_id").parquet(path))


def dim_store(fact: DataFrame, keyed: bool = False) -> DataFrame:
    """Stores and their countries; `keyed` adds the key that facts carry."""
    stores = fact.where(filled(F.col("store_id"))).select("store_id", "country_code").distinct()
    return with_key(stores, "store_key", ["store_id", "country_code"]) if keyed else stores


def build_dim_store(json_df: DataFrame, keyed: bool = False) -> DataFrame:
    return dim_store(build_fact_event(json_df, ["store_id", "country_code"]), keyed)


def with_key(dim: DataFrame, name: str, natural: list[str]) -> DataFrame:
    return dim.withColumn(name, surrogate_key(*[F.col(c) for c in natural]))


def star_counts(fact: DataFrame, dims: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Events per dimension attributes `by`.  `dims` maps a key column to its dimension.

    Facts are counted per combination of keys first, so what the joins move is the combinations, and a
    frequent key is as many rows as it has combinations.  No broadcast hint: dates and currencies
    broadcast by their statistics, while customers or devices may outgrow memory and then shuffle
    (AQE splits a skewed key).  A key without a dimension row counts under NULL attributes.
    """
    counted = fact.groupBy(*dims).agg(F.count(F.lit(1)).alias("events"))
    for key, dim in dims.items():
        counted = counted.join(dim, key, "left")
    return counted.groupBy(*by).agg(F.sum("events").alias("events"))
