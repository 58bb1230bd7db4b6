"""Frequent keys of a table partitioned by date, kept beside it by the load.

The plan-shaping list of heavy keys (`skew`) needs a count of every key.  Here each date keeps the keys
that hold more than `share` of its own rows, and what the others hold at most.  Summaries of dates are
merged by adding up, without reading the table:

* a key that no date kept holds at most `share` of every date, so at most `share` of all rows;
* a kept key holds what was counted, and at most `share` of each date that did not keep it.

A date keeps at most `1 / share` keys per column.  Dates are replaced whole, so a repeated load changes
nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.operators.skew import FLOOR, SHARE

# A summary keeps keys from a quarter of the share on that makes a key heavy: merged bounds are then
# sharp enough that at most 4 / 3 times the possible number of heavy keys are taken for heavy.
KEPT = SHARE / 4


def frequent_keys(rows: DataFrame, columns: list[str], by: str = "date_id", share: float = KEPT) -> DataFrame:
    """date, key_name, key (text; NULL in the row that stands for all), n and bound of every date in `rows`:
    the keys with more than `bound` rows.  NULL keys do not count."""
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("key_name"), F.col(c).cast("string").alias("key")) for c in columns]))
    counts = (rows.select(by, each).where(F.col("key").isNotNull())
              .groupBy(by, "key_name", "key").agg(F.count(F.lit(1)).alias("n")))
    whole = counts.groupBy(by, "key_name").agg(F.sum("n").alias("total"))
    bound = F.floor(F.col("total") * share).cast("bigint").alias("bound")
    kept = counts.join(whole, [by, "key_name"]).select(by, "key_name", "key", "n", bound)
    every = whole.select(by, "key_name", F.lit(None).cast("string").alias("key"), F.col("total").alias("n"), bound)
    return kept.where(F.col("n") > F.col("bound")).unionByName(every)


def write_frequent_keys(rows: DataFrame, columns: list[str], path: str, by: str = "date_id", share: float = KEPT) -> None:
    """Write the summaries of the dates in `rows`, replacing those that are there.  What is kept is dealt by date:
    folding partitions instead would count all keys in the task that writes."""
    (frequent_keys(rows, columns, by, share).hint("rebalance", by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def heavy_from_summaries(summaries: DataFrame, column: str, share: float = SHARE, floor: int = FLOOR) -> DataFrame:
    """Heavy keys with their number of pieces, as `skew.heavy_keys` gives them for the whole table: every key
    that may hold more than `share` of all rows and more than `floor`."""
    of = summaries.where(F.col("key_name") == column)
    total, bounds = _whole(of, "n"), _whole(of, "bound")
    most = F.col("n") + bounds - F.col("bounds")
    limit = F.greatest(F.lit(float(max(floor, 1))), total * F.lit(share))
    keys = of.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("n").alias("n"), F.sum("bound").alias("bounds"))
    return (keys.where(most > limit)
            .select(F.col("key").alias(column), F.ceil(most / limit).cast("int").alias("_pieces")))


def _whole(summaries: DataFrame, column: str) -> Column:
    return summaries.where(F.col("key").isNull()).agg(F.sum(column)).scalar()


def merged(parts: list[DataFrame]) -> DataFrame:
    """Summaries of several tables of the same dates or others, to be read as one."""
    return reduce(DataFrame.unionByName, parts)
