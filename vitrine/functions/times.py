"""Reading event times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE]\+?[0-9]{1,2})?$"


def event_time(raw: Column) -> Column:
    """Text to TIMESTAMP: a number of 12 to 14 digits is epoch milliseconds, one of up to 17 digits is
    microseconds, one of up to 19 nanoseconds, and a smaller one is epoch seconds; all may be
    negative.  Anything else is tried as an ISO time.  Unreadable text gives NULL."""
    text = F.trim(raw)
    # JSON numbers with a fraction arrive in scientific notation.
    number = text.try_cast("decimal(38,6)")
    size = F.abs(number)
    return (
        F.when(~text.rlike(NUMBER), text.try_cast("timestamp"))
        .when(size < 10 ** 11, F.timestamp_seconds(number.try_cast("decimal(17,6)")))
        .when(size < 10 ** 14, F.timestamp_millis(number.try_cast("bigint")))
        .when(size < 10 ** 17, F.timestamp_micros(number.try_cast("bigint")))
        .when(size < F.lit(1e19), F.timestamp_micros(F.floor(number / 1000).try_cast("bigint")))
    )


def date_id(day: Column) -> Column:
    """Integer yyyyMMdd of a date, by arithmetic instead of formatting and parsing."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
