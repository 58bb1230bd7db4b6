"""Compare a Spark result with DuckDB: column names, row count and values, ignoring row order."""

from __future__ import annotations

import datetime
import decimal

import duckdb

from vitrine.checks.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value) -> str:
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def normalised(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else a short description."""
    left = normalised(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} and {right[0]}"
    if left[1] != right[1]:
        only_left = [r for r in left[1] if r not in set(right[1])][:2]
        only_right = [r for r in right[1] if r not in set(left[1])][:2]
        return f"{len(left[1])} and {len(right[1])} rows; only Spark {only_left}; only SQL {only_right}"
    return None
