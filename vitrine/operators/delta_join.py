"""Inner joins of growing tables, round by round.

Both sides are incremental tables in buckets by the join key.  A round brings new rows of either side and
adds to the result

    new left with all right, old left with new right,

for which it reads old rows out of the buckets of its new ones only.  New rows of both sides and of the
result become visible by one log entry, so a round that is repeated adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.operators.merge import FINAL_COLUMNS
from vitrine.streaming import log
from vitrine.streaming.log import Snapshot
from vitrine.streaming.state import bucket_of, touched_buckets
from vitrine.streaming.upsert import compact, is_done, read_current, stored_parts, write_tables

LEFT, RIGHT, RESULT = "left", "right", "result"


def _old(spark: SparkSession, root: str, table: str, seen: Snapshot, buckets: list[int], like: DataFrame) -> DataFrame:
    """Stored rows of one side in some buckets."""
    stored = stored_parts(spark, root, table, seen) if buckets else None
    return like.limit(0) if stored is None else stored.where(F.col("bucket").isin(buckets)).select(like.columns)


def join_round(left: DataFrame, right: DataFrame, key: str, root: str, batch_id: int, run: str,
               buckets: int = 64, compact_every: int = 20) -> bool:
    """Take in a round's new rows, which must not have come before; rows without a key join nothing."""
    spark = left.sparkSession
    if is_done(spark, root, batch_id, run):
        return False
    seen = log.snapshot(spark, root)
    sides = [rows.where(F.col(key).isNotNull()).withColumn("bucket", bucket_of([key], buckets)).persist()
             for rows in (left, right)]
    try:
        new_left, new_right = sides
        old_left = _old(spark, root, LEFT, seen, touched_buckets(new_right), new_left)
        old_right = _old(spark, root, RIGHT, seen, touched_buckets(new_left), new_right)
        on = [key, "bucket"]
        result = new_left.join(old_right.unionByName(new_right), on).unionByName(old_left.join(new_right, on))
        return write_tables({LEFT: new_left, RIGHT: new_right, RESULT: result.drop("bucket")}, root, batch_id, run)
    finally:
        for rows in sides:
            rows.unpersist()
        if len(seen.deltas(LEFT)) + 1 >= compact_every:
            fold_join(spark, root)


def fold_join(spark: SparkSession, root: str) -> None:
    """Join deltas to the bases as they are."""
    compact(spark, root, None, LEFT, ["bucket"])
    compact(spark, root, None, RIGHT, ["bucket"])
    compact(spark, root, None, RESULT)


def read_joined(spark: SparkSession, root: str, seen: Snapshot | None = None) -> DataFrame:
    return read_current(spark, root, lambda rows: rows, RESULT, seen)


def round_result(spark: SparkSession, root: str, batch_id: int, run: str) -> DataFrame:
    """What a committed round has added."""
    order = log.run_number(spark, root, run) * log.RUN + batch_id
    return spark.read.parquet(f"{root}/{log.snapshot(spark, root).batches[order][RESULT]}")


def merge_round(products: DataFrame, pages: DataFrame, info: DataFrame, root: str, batch_id: int, run: str,
                **settings) -> None:
    """A round of the product merge, as `merge_product_final` does it for everything at once: `products`
    (dim_product), `pages` (product_id, current_url) and `info` (product_info) hold what is new since the round
    before.  New products meet all their pages, known ones their new pages, and pages their new details."""
    details = info.select("current_url", "product_name", "price", "description")
    join_round(pages.select("product_id", "current_url"), details, "current_url", f"{root}/pages", batch_id, run, **settings)
    read = round_result(products.sparkSession, f"{root}/pages", batch_id, run)
    join_round(products, read.drop("current_url"), "product_id", f"{root}/final", batch_id, run, **settings)


def read_merged(spark: SparkSession, root: str) -> DataFrame:
    return read_joined(spark, f"{root}/final").select(FINAL_COLUMNS)
