"""Customer dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.text import blank_to_null, filled
from vitrine.operators.parse import parse_events

CUSTOMER_FIELDS = ["_id", "time_stamp", "user_id_db", "show_recommendation", "email_address"]


def customer_key_columns() -> tuple[Column, Column]:
    return F.trim("user_id_db"), F.trim("email_address")


def customer_rows(events: DataFrame, null_blank: bool = False) -> DataFrame:
    user, mail = customer_key_columns()
    if null_blank:
        user, mail = blank_to_null(user), blank_to_null(mail)
    rows = events.withColumns({"user_id": user, "email_address": mail})
    return rows.where(filled(F.col("user_id")) | filled(F.col("email_address")))


def customers(events: DataFrame, null_blank: bool = False) -> DataFrame:
    """One row per (user_id, email_address), NULL and '' being different keys unless `null_blank`;
    show_recommendation is that of the latest event."""
    latest = F.max(F.struct("time_stamp", "_id", F.col("show_recommendation").alias("value")))
    return (
        customer_rows(events, null_blank).groupBy("user_id", "email_address")
        .agg(latest["value"].alias("show_recommendation"))
    )


def build_dim_customer(json_df: DataFrame, null_blank: bool = False) -> DataFrame:
    return customers(parse_events(json_df, CUSTOMER_FIELDS), null_blank)
