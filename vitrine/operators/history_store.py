"""Product history kept up to date from batches of versions.

Observed versions and the validity intervals made from them are incremental tables in one commit log,
cut into buckets by product.  A batch reads the observed versions of its own products, out of the
buckets these fall into, builds their intervals anew and writes them as the products' newest; a late
version thereby splits, shortens or merges intervals, whichever it touches.  Intervals alone would not
do: a value seen again inside its interval begins an interval of its own once a late version with
another value comes before it, so the observations stay.  Versions that are known already change
nothing, and products without new ones are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.operators.history import TRACKED, product_history
from vitrine.operators.skew import heavy_keys
from vitrine.streaming import log
from vitrine.streaming.state import bucket_of, touched_buckets
from vitrine.streaming.upsert import compact, is_done, read_current, stored_parts, write_tables

VERSIONS, SPANS = "versions", "spans"
COLUMNS = ["product_id", *TRACKED, "seen_at"]


def _in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", bucket_of(["product_id"], buckets))


def update_history(versions: DataFrame, root: str, batch_id: int, run: str, buckets: int = 256,
                   compact_every: int = 20) -> bool:
    """Take in a batch of versions (product_id, product_name, raw_price, seen_at)."""
    spark = versions.sparkSession
    if is_done(spark, root, batch_id, run):
        return False
    seen = log.snapshot(spark, root)
    usable = versions.where(F.col("product_id").isNotNull() & F.col("seen_at").isNotNull())
    fresh = _in_buckets(usable.select(COLUMNS).distinct(), buckets).persist()
    try:
        stored = stored_parts(spark, root, VERSIONS, seen)
        if stored is None:
            new, whole = fresh, fresh
        else:
            known = (stored.drop("batch").where(F.col("bucket").isin(touched_buckets(fresh)))
                     .join(fresh.select("product_id").distinct(), "product_id", "left_semi").select(fresh.columns))
            new = fresh.subtract(known)
            # Products all of whose versions are known stay as they are.
            changed = new.select("product_id").distinct()
            whole = known.unionByName(new).join(changed, "product_id", "left_semi")
        # The history reads its versions several times, and seldom has a heavy product among them.
        whole = whole.select(COLUMNS).persist()
        try:
            hot = heavy_keys(whole, "product_id")
            spans = _in_buckets(product_history(whole, False if hot.isEmpty() else hot), buckets)
            done = write_tables({VERSIONS: new, SPANS: spans}, root, batch_id, run)
        finally:
            whole.unpersist()
    finally:
        fresh.unpersist()
    if len(seen.deltas(VERSIONS)) + 1 >= compact_every:
        fold_history(spark, root)
    return done


def _newest_of_products(stored: DataFrame) -> DataFrame:
    """All intervals of the newest batch that wrote a product."""
    last = stored.groupBy("product_id").agg(F.max("batch").alias("batch"))
    return stored.join(last, ["product_id", "batch"])


def read_history(spark: SparkSession, root: str) -> DataFrame:
    return read_current(spark, root, _newest_of_products, SPANS).drop("bucket")


def fold_history(spark: SparkSession, root: str) -> None:
    """Fold both tables; versions are joined to the base as they are."""
    compact(spark, root, None, VERSIONS, ["bucket"])
    compact(spark, root, _newest_of_products, SPANS, ["bucket"])
