"""Exact operators that survive a key holding a large part of all rows.

A plain window or join sends one key to one task.  Here such keys are found first (a map-side
combined count), and only their rows are cut into pieces:

* a key is *heavy* when it holds more than `share` of all rows, so there are at most `1 / share`
  heavy keys: the broadcast list has that bound whatever the data size;
* every other key is at most `share` of the rows, which is what one task may get.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SHARE = 1e-5
# Below this many rows a key is never worth splitting.
FLOOR = 1_000_000


def heavy_from_counts(counts: DataFrame, key: str, n: str, share: float = SHARE,
                      floor: int = FLOOR) -> DataFrame:
    """Heavy keys of a (key, count) table, with the number of pieces each is to be cut into.

    The pieces add up to at most `2 / share` over all heavy keys.
    """
    limit = F.greatest(F.lit(float(max(floor, 1))),
                       counts.agg(F.sum(n).alias("total")).scalar() * F.lit(share))
    return (counts.where(F.col(n) > limit)
            .select(key, F.ceil(F.col(n) / limit).cast("int").alias("_pieces")))


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, floor: int = FLOOR) -> DataFrame:
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return heavy_from_counts(counts, key, "_n", share, floor)


def join_in_pieces(big: DataFrame, small: DataFrame, key: str, heavy: DataFrame,
                   spread: list[str]) -> DataFrame:
    """Inner join on `key` in which the heavy keys of `big` are cut by a hash of `spread`.

    The pieces depend on row values only, so a recomputed task yields the same rows.  `small` is
    repeated once per piece, and only for heavy keys.
    """
    hot = F.broadcast(heavy)
    cut = (big.join(hot, key, "left")
           .withColumn("_piece", F.when(F.col("_pieces").isNull(), F.lit(0))
                       .otherwise(F.pmod(F.xxhash64(*spread), F.col("_pieces")).cast("int")))
           .drop("_pieces"))
    copies = (small.join(hot, key, "left")
              .withColumn("_piece", F.explode(F.sequence(
                  F.lit(0), F.coalesce(F.col("_pieces") - 1, F.lit(0)))))
              .drop("_pieces"))
    return cut.join(copies, [key, "_piece"]).drop("_piece")


def neighbour(df: DataFrame, key: str, time: str, tie: list[str], values: dict[str, Column],
              step: int = 1, into: str = "near", heavy: DataFrame | bool | None = None,
              slice_seconds: int = 60) -> DataFrame:
    """Add a struct column `into`: `values` of the next (`step=1`) or previous (`step=-1`) row of
    the same key in (time, tie) order; NULL at the end.  Key and time must not be NULL.

    The same result as lead/lag over the key.  Rows of heavy keys are cut into time slices; the
    first (last) row of each slice is handed to the slice before (after) it as a marker row, so a
    plain window over (key, slice) sees its true neighbour.  `heavy=False` says that no key is heavy, which
    is the plain window.
    """
    if step not in (1, -1):
        raise ValueError("step is 1 or -1")
    if heavy is False:
        near = (F.lead if step == 1 else F.lag)(F.struct(*[c.alias(name) for name, c in values.items()]))
        return df.withColumn(into, near.over(Window.partitionBy(key).orderBy(time, *tie)))
    heavy = heavy_keys(df, key) if heavy is None else heavy
    cut = F.floor(F.unix_seconds(F.col(time)) / slice_seconds)
    row = F.struct(*[c.alias(name) for name, c in values.items()])
    slim = df.select(key, time, *tie, row.alias("_row"))
    order = [time, *tie]

    edge_of = F.min if step == 1 else F.max
    pick = F.lead if step == 1 else F.lag
    edges = (
        slim.join(F.broadcast(heavy), key).withColumn("_slice", cut)
        .groupBy(key, "_slice").agg(edge_of(F.struct(*order, "_row")).alias("_edge"))
    )
    markers = (
        edges.withColumn("_edge", pick("_edge").over(Window.partitionBy(key).orderBy("_slice")))
        .where(F.col("_edge").isNotNull())
        .select(key, "_slice", *[F.col("_edge")[c].alias(c) for c in order],
                F.col("_edge")["_row"].alias("_row"), F.lit(True).alias("_marker"))
    )
    rows = (
        df.join(F.broadcast(heavy.select(key, F.lit(True).alias("_hot"))), key, "left")
        .withColumns({"_slice": F.when(F.col("_hot"), cut).otherwise(F.lit(0)).cast("bigint"),
                      "_row": row, "_marker": F.lit(False)})
        .drop("_hot")
    )
    window = Window.partitionBy(key, "_slice").orderBy(*order)
    return (
        rows.unionByName(markers, allowMissingColumns=True)
        .withColumn(into, pick("_row").over(window))
        .where(~F.col("_marker")).drop("_slice", "_row", "_marker")
    )


def even_bands(df: DataFrame, measure: str, key: str, bands: int, into: str = "band") -> DataFrame:
    """ntile(bands) over (measure, md5(key)) without sorting the whole table in one task.

    Rows are counted per (measure, hash bucket); running sums over those counts give every bucket
    its first position, and ranks are taken inside buckets only.  The table that one task sorts
    has one row per distinct measure: a count that sums to N has at most sqrt(2N) distinct values.
    """
    digest = F.md5(F.col(key).cast("binary"))
    rows = df.withColumns({"_hash": digest, "_bucket": F.substring(digest, 1, 3)})
    counts = rows.groupBy(measure, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    per_measure = counts.groupBy(measure).agg(F.sum("_n").alias("_m"))
    before = Window.orderBy(measure).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_measure.select(
        measure, F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_measure_start"))
    inside = (Window.partitionBy(measure).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(starts, measure)
        .select(measure, "_bucket", (F.col("_measure_start") + F.col("_inside")).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy(measure, "_bucket").orderBy("_hash", key))
    total = per_measure.agg(F.sum("_m").alias("total")).scalar()
    ranked = (rows.withColumn("_rank", rank).join(offsets, [measure, "_bucket"])
              .withColumn("_at", F.col("_start") + F.col("_rank") - 1)
              .withColumn("_total", total))
    # ntile: the first (total % bands) bands hold one row more than the others.
    size = F.floor(F.col("_total") / bands)
    extra = F.col("_total") % bands
    head = extra * (size + 1)
    band = F.when(F.col("_at") < head, F.floor(F.col("_at") / (size + 1))).otherwise(
        extra + F.floor((F.col("_at") - head) / F.greatest(size, F.lit(1))))
    return (ranked.withColumn(into, (band + 1).cast("int"))
            .drop("_hash", "_bucket", "_rank", "_start", "_at", "_total"))
