"""Currency dimension: raw event currency matched to a reference list by symbol or by code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.functions.money import price_amount, price_currency, to_usd
from vitrine.functions.text import filled
from vitrine.operators.parse import parse_events
from vitrine.schemas import CURRENCY
from vitrine.sources.currency_list import currency_list

REFERENCE_COLUMNS = [f.name for f in CURRENCY.fields]


def currency_keys(reference: DataFrame, mode: str = "all") -> DataFrame:
    """Reference rows keyed by what may match them.

    "Symbol OR code" becomes two key rows per reference row, so the match is an equality that
    Spark can hash instead of a nested loop over an OR condition.
    `mode="best"` keeps one row per key: a code match first, then the lowest currency code.
    """
    keyed = reference.select(
        F.explode(F.array_distinct(F.array("symbol", "currency_code"))).alias("match_key"),
        *REFERENCE_COLUMNS,
    ).where(F.col("match_key").isNotNull())
    if mode == "all":
        return keyed
    if mode != "best":
        raise ValueError(f"unknown mode {mode!r}")
    rank = F.struct((F.col("match_key") != F.col("currency_code")).alias("by_symbol"), *REFERENCE_COLUMNS)
    return keyed.groupBy("match_key").agg(F.min(rank).alias("row")).select(
        "match_key", *[F.col(f"row.{name}").alias(name) for name in REFERENCE_COLUMNS])


def match_currency(rows: DataFrame, raw: str | Column, reference: DataFrame,
                   mode: str = "all") -> DataFrame:
    """Left join of `rows` to the reference on a raw currency text.

    No broadcast hint: the reference is the caller's, so its size decides through Spark's own
    statistics; the short list broadcasts, a large table would be shuffled and skew-split.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    keys = currency_keys(reference, mode)
    return rows.join(keys, raw == keys["match_key"], "left").drop("match_key")


def build_dim_currency(json_df: DataFrame, spark: SparkSession | None = None,
                       reference: DataFrame | None = None, mode: str = "all",
                       distinct: bool = False) -> DataFrame:
    """Raw currencies with the reference columns; unmatched ones keep NULLs.  One row per event
    and match unless `distinct`."""
    if reference is None:
        reference = currency_list(spark or json_df.sparkSession)
    raw = (parse_events(json_df, ["currency"]).select(F.col("currency").alias("raw_currency"))
           .where(filled(F.col("raw_currency"))))
    if distinct:
        raw = raw.distinct()
    return match_currency(raw, "raw_currency", reference, mode)


def prices_in_usd(product_info: DataFrame, reference: DataFrame) -> DataFrame:
    """Price text split into amount and currency, matched once (`best`) and converted.  A column
    `price_structured`, where there is one, tells prices whose decimal mark is a point."""
    # A generator ends the lineage of the join key: tracing it through the page-extraction
    # expressions would cost the optimiser seconds.
    structured = F.col("price_structured") if "price_structured" in product_info.columns else F.lit(False)
    parts = F.struct(price_amount(F.col("price"), structured=structured).alias("amount"),
                     price_currency(F.col("price")).alias("raw_currency"))
    rows = product_info.select("current_url", "price", F.inline(F.array(parts)))
    matched = match_currency(rows, "raw_currency", reference, "best")
    return matched.select("current_url", "price", "amount", "currency_code",
                          to_usd(F.col("amount"), F.col("usd_exchange_rate")).alias("amount_usd"))
