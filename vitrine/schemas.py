"""Table schemas, declared in code and never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


STRING, INT, BOOLEAN = T.StringType(), T.IntegerType(), T.BooleanType()
TIME, DATE = T.TimestampType(), T.DateType()

OPTION_TYPE = T.ArrayType(struct(
    option_label=STRING, option_id=STRING, value_label=STRING, value_id=STRING))

# The event fields and their order.
EVENT_FIELDS = [
    "_id", "time_stamp", "ip", "user_agent", "resolution", "user_id_db", "device_id",
    "api_version", "store_id", "local_time", "show_recommendation", "current_url",
    "referrer_url", "email_address", "collection", "product_id", "option", "id", "currency",
]

CORRUPT = "_corrupt_record"


def event_schema(fields: list[str] | None = None, time_type: T.DataType = STRING,
                 corrupt: bool = False) -> T.StructType:
    """Event schema cut to `fields`, so that from_json only materialises what a job reads.

    `time_stamp` is text by default: producers send epoch milliseconds, which a TIMESTAMP field
    would read as seconds.  Pass `time_type=TIME` for that literal reading.
    """
    wanted = EVENT_FIELDS if fields is None else fields
    unknown = set(wanted) - set(EVENT_FIELDS)
    if unknown:
        raise ValueError(f"unknown event fields: {sorted(unknown)}")
    types = {"time_stamp": time_type, "option": OPTION_TYPE}
    columns = {n: types.get(n, STRING) for n in EVENT_FIELDS if n in wanted}
    if corrupt:
        columns[CORRUPT] = STRING
    return struct(**columns)


DIM_DATE = struct(
    ("date_id",), date_id=INT, date=DATE, day=INT, month=INT, month_name=STRING, year=INT,
    weekday=INT, weekday_name=STRING, is_weekend=BOOLEAN)

DIM_DEVICE = struct(
    device_id=STRING, device_type=STRING, model=STRING, system=STRING, browser=STRING)

CURRENCY = struct(
    ("currency_code",), currency_code=STRING, currency_name=STRING, symbol=STRING,
    country_code=STRING, usd_exchange_rate=T.DecimalType(18, 6))

PRODUCT_INFO = struct(product_name=STRING, price=STRING, description=STRING, current_url=STRING, error=STRING)

DIM_PRODUCT = struct(
    product_id=STRING, collection=STRING, diamond_option_id=STRING, alloy_option_id=STRING)

DIM_PRODUCT_FINAL = struct(
    product_id=STRING, diamond_option_id=STRING, alloy_option_id=STRING, product_name=STRING,
    collection=STRING, price=STRING, description=STRING)

DIM_PRODUCT_HISTORY = struct(
    ("product_id",), product_id=STRING, product_name=STRING, category=STRING, raw_price=STRING,
    price=T.DecimalType(10, 2), quality=STRING, quality_label=STRING, record_created_date=TIME,
    record_expired_date=TIME, is_current_record=BOOLEAN)
