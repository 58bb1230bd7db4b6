"""JSON text to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.times import event_time
from vitrine.schemas import CORRUPT, EVENT_FIELDS, STRING, TIME, event_schema

# Text that an event time was read from.
TIME_TEXT = "_time_text"


def decode_value(records: DataFrame) -> DataFrame:
    """Broker records (binary `value`) to one `json_str` column."""
    return records.select(F.col("value").cast("string").alias("json_str"))


def parse_events(json_df: DataFrame, fields: list[str] | None = None,
                 time_mode: str = "normalised", corrupt: bool = False) -> DataFrame:
    """Parse `json_str` into event columns; malformed text gives a row of NULLs, never an error.

    `fields` narrows the schema handed to from_json.  Catalyst prunes a JSON schema only when a
    single field is read, so every builder names what it needs.
    `time_mode="reference"` lets from_json read `time_stamp` as TIMESTAMP (numbers as seconds).
    `corrupt=True` keeps the input columns and adds `_corrupt_record` and the time's text.
    """
    if time_mode not in ("normalised", "reference"):
        raise ValueError(f"unknown time_mode {time_mode!r}")
    wanted = EVENT_FIELDS if fields is None else [f for f in EVENT_FIELDS if f in fields]
    time_type = TIME if time_mode == "reference" else STRING
    options = {"columnNameOfCorruptRecord": CORRUPT} if corrupt else {}
    data = F.from_json("json_str", event_schema(fields, time_type, corrupt), options)
    # inline() instead of `data.*`: filters on parsed fields would be pushed below a projection
    # together with a second copy of from_json; they stay above a generator, and each text is
    # parsed once.
    parsed = json_df.select(*(json_df.columns if corrupt else []), F.inline(F.array(data)))
    if "time_stamp" in wanted and time_mode == "normalised":
        if corrupt:
            parsed = parsed.withColumn(TIME_TEXT, F.col("time_stamp"))
        parsed = parsed.withColumn("time_stamp", event_time(F.col("time_stamp")))
    return parsed
