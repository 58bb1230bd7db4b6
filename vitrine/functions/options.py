"""Reading one labelled choice out of an event's option list."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def option_id(options: Column, label: str) -> Column:
    """First non-NULL option_id with this exact label; '' counts as a value.

    A filter over the array keeps one row per event; exploding and grouping again would double
    the rows and shuffle them.
    """
    hits = F.filter(options, lambda o: (o["option_label"] == label) & o["option_id"].isNotNull())
    return F.get(hits, F.lit(0))["option_id"]


def has_options(options: Column) -> Column:
    return F.coalesce(F.size(options), F.lit(0)) > 0
