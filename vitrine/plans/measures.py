"""What counts as a view or a purchase, and shared measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Event classes in `collection`.
VIEW = "view_product_detail"
PURCHASE = "purchase"


def is_view() -> Column:
    return F.col("collection") == VIEW


def is_purchase() -> Column:
    return F.col("collection") == PURCHASE


def rows() -> Column:
    return F.count(F.lit(1))


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def grand_total(table: DataFrame, column: str) -> Column:
    """Sum of a column of an aggregated table as a scalar subquery (no window over all rows)."""
    return table.agg(F.sum(column).alias("total")).scalar()
