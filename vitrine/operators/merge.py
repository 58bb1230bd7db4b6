"""Joining crawled product pages to the product dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.operators.pages import MISSING
from vitrine.schemas import DIM_PRODUCT_FINAL

FINAL_COLUMNS = [f.name for f in DIM_PRODUCT_FINAL.fields]


def merge_product_final(dim_product: DataFrame, dim_prd: DataFrame, product_info: DataFrame,
                        existing: DataFrame | None = None, mode: str = "all") -> DataFrame:
    """Rows to append to dim_product_final: products not yet in `existing`, with page details.

    `mode="all"` keeps every combination of dimension, page and page-info rows.
    `mode="latest"` gives one row per product: the page seen last (by `last_seen` when dim_prd has
    it), a page with a real name before one without.  Each input is cut to one row per key before
    the join, so duplicates never multiply.
    Known products are removed first: an anti join narrows everything after it.
    """
    if existing is not None:
        dim_product = dim_product.join(existing.select("product_id").distinct(), "product_id",
                                       "left_anti")
    if mode == "latest":
        dim_product, pages = _one_per_product(dim_product, dim_prd, product_info)
        joined = dim_product.join(pages, "product_id")
    elif mode == "all":
        pages = dim_prd.select("product_id", "current_url")
        joined = dim_product.join(pages, "product_id").join(
            product_info.select("current_url", "product_name", "price", "description"), "current_url")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined.select(FINAL_COLUMNS)


def _one_per_product(dim_product: DataFrame, dim_prd: DataFrame,
                     product_info: DataFrame) -> tuple[DataFrame, DataFrame]:
    options = (dim_product.groupBy("product_id")
               .agg(F.min(F.struct("collection", "diamond_option_id", "alloy_option_id")).alias("o"))
               .select("product_id", "o.*"))
    named = F.struct((F.col("product_name") != MISSING).alias("named"), "product_name", "price",
                     "description")
    info = product_info.groupBy("current_url").agg(F.max(named).alias("i"))
    seen = F.col("last_seen") if "last_seen" in dim_prd.columns else F.lit(None).cast("timestamp")
    pages = (
        dim_prd.select("product_id", "current_url", seen.alias("seen")).join(info, "current_url")
        .groupBy("product_id")
        .agg(F.max(F.struct(F.col("i.named").alias("named"), "seen", "current_url", "i")).alias("p"))
        .select("product_id", "p.i.product_name", "p.i.price", "p.i.description")
    )
    return options, pages


def append_missing(rows: DataFrame, path: str) -> None:
    """Append merge output to the final table; rerunning the merge then finds nothing new."""
    rows.write.mode("append").parquet(path)
