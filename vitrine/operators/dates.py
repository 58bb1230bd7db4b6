"""Date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.text import or_sentinel
from vitrine.functions.times import date_id
from vitrine.operators.parse import parse_events
from vitrine.schemas import DIM_DATE


def event_days(events: DataFrame, null_time: str | Column = "now") -> DataFrame:
    """Distinct event days.  A missing time counts as now, is dropped ("drop"), or is replaced by
    a given column."""
    day = F.to_date("time_stamp")
    if isinstance(null_time, Column):
        day = F.coalesce(day, F.to_date(null_time))
    elif null_time == "now":
        day = F.coalesce(day, F.to_date(F.current_timestamp()))
    elif null_time != "drop":
        raise ValueError(f"unknown null_time {null_time!r}")
    return events.select(day.alias("date")).where(F.col("date").isNotNull()).distinct()


def date_attributes(days: DataFrame) -> DataFrame:
    """Calendar columns of each day; weekday runs from Sunday=1 to Saturday=7."""
    day = F.col("date")
    columns = {
        "date_id": date_id(day),
        "date": day,
        "day": F.coalesce(F.dayofmonth(day), F.lit(-1)),
        "month": F.coalesce(F.month(day), F.lit(-1)),
        "month_name": or_sentinel(F.date_format(day, "MMMM")),
        "year": F.coalesce(F.year(day), F.lit(-1)),
        "weekday": F.coalesce(F.dayofweek(day), F.lit(-1)),
        "weekday_name": or_sentinel(F.date_format(day, "EEEE")),
        "is_weekend": F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False)),
    }
    return days.select([columns[f.name].cast(f.dataType).alias(f.name) for f in DIM_DATE.fields])


def build_dim_date(json_df: DataFrame, null_time: str | Column = "now",
                   time_mode: str = "normalised") -> DataFrame:
    """Days are made distinct first, so calendar functions run once per day, not once per event."""
    return date_attributes(event_days(parse_events(json_df, ["time_stamp"], time_mode), null_time))
