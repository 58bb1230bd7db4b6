"""Product history (slowly changing dimension, type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.functions.money import price_amount
from vitrine.operators.skew import heavy_keys, neighbour
from vitrine.schemas import DIM_PRODUCT_HISTORY

TRACKED = ["product_name", "raw_price"]


def product_history(versions: DataFrame, heavy: DataFrame | bool | None = None) -> DataFrame:
    """versions(product_id, product_name, raw_price, seen_at) to validity intervals.

    A record starts where a tracked value differs from the one before and is valid until the next
    record starts (half-open; NULL while current).  category, quality and quality_label have no
    source and stay NULL.
    """
    rows = versions.where(F.col("product_id").isNotNull() & F.col("seen_at").isNotNull())
    tracked = {c: F.col(c) for c in TRACKED}
    heavy = heavy_keys(rows, "product_id") if heavy is None else heavy
    before = neighbour(rows, "product_id", "seen_at", TRACKED, tracked, step=-1, into="before",
                       heavy=heavy)
    same = F.lit(True)
    for c in TRACKED:
        same = same & F.col(c).eqNullSafe(F.col("before")[c])
    changes = before.where(F.col("before").isNull() | ~same).drop("before")
    spans = neighbour(changes, "product_id", "seen_at", TRACKED, {"at": F.col("seen_at")}, step=1,
                      into="after", heavy=heavy)
    columns = {
        "price": price_amount(F.col("raw_price"), "decimal(10,2)"),
        "record_created_date": F.col("seen_at"),
        "record_expired_date": F.col("after.at"),
        "is_current_record": F.col("after").isNull(),
        **{c: F.lit(None) for c in ("category", "quality", "quality_label")},
    }
    return spans.select([columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                         for f in DIM_PRODUCT_HISTORY.fields])
