"""Dimensions as mergeable states: one definition for batch and for incremental upkeep.

A table is described by its key and by min/max states per key.  Min and max are associative, so

* a batch build reduces all events once and finishes the states into the table;
* a stream reduces each micro-batch and stores the small result; reading combines what is stored.

Replaying or reordering micro-batches cannot change the outcome, and no streaming state store has
to remember every key ever seen.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.text import filled, or_sentinel
from vitrine.operators import customers as cust
from vitrine.operators import dates, devices, option_dims
from vitrine.operators import products as prod
from vitrine.operators.currency import match_currency
from vitrine.operators.facts import with_key
from vitrine.sources.currency_list import currency_list


@dataclass(frozen=True)
class Mergeable:
    fields: list[str]
    keys: list[str]
    rows: Callable[[DataFrame], DataFrame]
    # Turns states into the table; further columns of the states are carried along.
    finish: Callable[..., DataFrame]
    # state name -> ("min" | "max", expression over `rows`)
    states: Callable[[], dict[str, tuple[str, Column]]] = dict
    # Surrogate key that facts carry; it is computed from `keys`.
    key: str | None = None

    def reduce(self, events: DataFrame) -> DataFrame:
        """Keys and states of some events."""
        return self._group(self.rows(events), self.states())

    def combine(self, stored: DataFrame) -> DataFrame:
        """Keys and states of several reduced parts."""
        return self._group(stored, {n: (f, F.col(n)) for n, (f, _) in self.states().items()})

    def build(self, events: DataFrame) -> DataFrame:
        return self.finish(self.reduce(events))

    def keyed(self, states: DataFrame) -> DataFrame:
        """The finished table with its surrogate key: one row per key, also where attributes are alike."""
        return self.finish(with_key(states, self.key, self.keys), [self.key])

    def _group(self, df: DataFrame, states: dict[str, tuple[str, Column]]) -> DataFrame:
        if not states:
            return df.select(*self.keys).distinct()
        pick = {"min": F.min, "max": F.max}
        return df.groupBy(*self.keys).agg(*[pick[f](c).alias(n) for n, (f, c) in states.items()])


def _choice(value: Column) -> tuple[str, Column]:
    return "min", F.when(value.isNotNull(), F.struct(*prod.event_order(value.alias("value"))))


def _option_table(label: str) -> Mergeable:
    return Mergeable(
        fields=option_dims.OPTION_FIELDS,
        keys=["optionLabel", "optionId"],
        rows=lambda events: option_dims.option_rows(events, label),
        states=lambda: {"s": ("min", F.struct(*prod.event_order(
            F.col("pos"), F.col("valueLabel"), F.col("valueId"))))},
        finish=lambda s, keep=(): s.select(*keep, "optionLabel", "optionId", F.col("s.valueLabel").alias("valueLabel"),
                                  F.col("s.valueId").alias("valueId")),
    )


def _currency_rows(events: DataFrame) -> DataFrame:
    return events.select(F.col("currency").alias("raw_currency")).where(filled(F.col("raw_currency")))


TABLES: dict[str, Mergeable] = {
    "dim_product": Mergeable(
        fields=prod.PRODUCT_FIELDS,
        keys=["product_id", "collection"],
        rows=prod.product_rows,
        states=lambda: {"diamond": _choice(F.col("diamond")), "alloy": _choice(F.col("alloy"))},
        key="product_key",
        finish=lambda s, keep=(): s.select(*keep, "product_id", "collection",
                                  or_sentinel(F.col("diamond.value")).alias("diamond_option_id"),
                                  or_sentinel(F.col("alloy.value")).alias("alloy_option_id")),
    ),
    "dim_prd": Mergeable(
        fields=["product_id", "current_url", "time_stamp"],
        keys=["product_id", "current_url"],
        rows=lambda events: events,
        states=lambda: {"last_seen": ("max", F.col("time_stamp"))},
        finish=lambda s, keep=(): s,
    ),
    "dim_date": Mergeable(
        fields=["time_stamp"],
        keys=["date"],
        rows=lambda events: dates.event_days(events, "drop"),
        finish=lambda s, keep=(): dates.date_attributes(s),
    ),
    "dim_currency": Mergeable(
        fields=["currency"],
        keys=["raw_currency"],
        rows=_currency_rows,
        finish=lambda s, keep=(): match_currency(s, "raw_currency", currency_list(s.sparkSession)),
    ),
    "dim_device": Mergeable(
        fields=["device_id", "user_agent"],
        keys=["device_id", "user_agent"],
        rows=lambda events: events,
        key="device_key",
        finish=lambda s, keep=(): devices.device_attributes(s, keep=list(keep)).distinct(),
    ),
    "dim_customer": Mergeable(
        fields=cust.CUSTOMER_FIELDS,
        keys=["user_id", "email_address"],
        rows=cust.customer_rows,
        states=lambda: {"latest": ("max", F.struct("time_stamp", "_id", F.col("show_recommendation").alias("value")))},
        key="customer_key",
        finish=lambda s, keep=(): s.select(*keep, "user_id", "email_address",
                                  F.col("latest.value").alias("show_recommendation")),
    ),
    "dim_diamond_option": _option_table(prod.DIAMOND),
    "dim_alloy_option": _option_table(prod.ALLOY),
}


def needed_fields(names: list[str]) -> list[str]:
    return sorted({field for name in names for field in TABLES[name].fields})
