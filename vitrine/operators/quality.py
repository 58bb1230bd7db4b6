"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.operators.parse import TIME_TEXT, parse_events
from vitrine.schemas import CORRUPT, EVENT_FIELDS


def checked_events(json_df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Parsed events with a `reason`: NULL for a good row, else empty, malformed (not a JSON
    object), bad_field (an object in which some field does not fit its type), no_fields (an object
    without any known field) or bad_time (a time is given but cannot be read).  All fields are
    checked, `fields` are returned."""
    rows = parse_events(json_df, corrupt=True)
    nothing = F.lit(True)
    for field in EVENT_FIELDS:
        nothing = nothing & F.col(TIME_TEXT if field == "time_stamp" else field).isNull()
    text = F.trim("json_str")
    is_object = F.coalesce(
        F.schema_of_variant(F.try_parse_json(F.col(CORRUPT))).startswith("OBJECT"), F.lit(False))
    reason = (
        F.when(text.isNull() | (text == ""), "empty")
        .when(F.col(CORRUPT).isNotNull(), F.when(is_object, "bad_field").otherwise("malformed"))
        .when(nothing, "no_fields")
        .when(F.col(TIME_TEXT).isNotNull() & F.col("time_stamp").isNull(), "bad_time")
    )
    wanted = EVENT_FIELDS if fields is None else [f for f in EVENT_FIELDS if f in fields]
    return rows.withColumn("reason", reason).select(*json_df.columns, *wanted, CORRUPT, "reason")


def split_events(json_df: DataFrame, fields: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good events, quarantined input rows with their reason)."""
    rows = checked_events(json_df, fields)
    good = rows.where(F.col("reason").isNull()).drop(CORRUPT, "reason", *json_df.columns)
    return good, rows.where(F.col("reason").isNotNull()).select(*json_df.columns, "reason")


def profile(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Per column: rows, NULLs, empty texts, and rows breaking the column's rule, from one
    aggregation over the table.  `rules` maps a column to a condition that good values meet."""
    rules = rules or {}
    kinds = dict(df.dtypes)
    cells = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        empty = F.count_if(c == "") if kinds[name] == "string" else F.lit(0).cast("bigint")
        broken = F.count_if(c.isNotNull() & ~rules[name]) if name in rules else F.lit(0).cast("bigint")
        cells.append(F.struct(F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("rows"),
                              F.count_if(c.isNull()).alias("nulls"), empty.alias("empties"),
                              broken.alias("violations")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def reference_gaps(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Facts whose key has no dimension row, counted per dimension.

    `dims` maps a name to (dimension, fact key column, dimension key column).  Facts are counted
    per key first, so a frequent key reaches the anti join as one row.
    """
    out = None
    for name, (dim, fact_key, dim_key) in dims.items():
        per_key = (fact.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("k"))
                   .agg(F.count(F.lit(1)).alias("n")))
        gaps = per_key.join(dim.select(F.col(dim_key).alias("k")).distinct(), "k", "left_anti").agg(
            F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("missing_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
        out = gaps if out is None else out.unionByName(gaps)
    return out


def key_audit(dims: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Rows, distinct keys and collisions (keys that stand for several natural keys) of each dimension;
    `dims` maps a name to (rows, key column, natural key columns)."""
    out = None
    for name, (rows, key, natural) in dims.items():
        # Natural keys are made distinct first; a key then has as many rows as it stands for.
        per_key = (rows.select(F.col(key).alias("k"), *natural).distinct()
                   .groupBy("k").agg(F.count(F.lit(1)).alias("n")))
        found = per_key.agg(F.lit(name).alias("dimension"), F.coalesce(F.sum("n"), F.lit(0)).alias("natural_keys"),
                            F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("collisions"))
        out = found if out is None else out.unionByName(found)
    return out


def audit_rows(df: DataFrame, table: str, batch_id: int) -> DataFrame:
    """One audit row of a written batch: rows and newest event time."""
    newest = F.max("time_stamp") if "time_stamp" in df.columns else F.lit(None).cast("timestamp")
    return df.agg(F.lit(table).alias("table_name"), F.lit(batch_id).cast("bigint").alias("batch_id"),
                  F.count(F.lit(1)).alias("rows"), newest.alias("max_event_time"))
