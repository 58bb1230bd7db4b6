"""State of a stream as an incremental table in buckets.

A state store holds every key it has seen in the memory or on the disks of the executors.  Here the
state is a table beside the output, cut into buckets by a hash of the key.  A micro-batch reads the
buckets its own keys fall into, and writes only the keys whose state it changes; output and state
become visible by one log entry, so a batch delivered again changes nothing.  Compaction folds the
state every few batches and leaves out what has expired by event time, so the state is as large as the
keys of the last `delay` of event time (or as the table itself where nothing expires).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.streaming import log
from vitrine.streaming.log import Snapshot
from vitrine.streaming.upsert import Combine, compact, is_done, read_current, run_of, stored_parts, write_tables

STATE, OUT, CLOCK = "state", "out", "clock"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def touched_buckets(rows: DataFrame) -> list[int]:
    """Buckets of some rows: a list no longer than the number of buckets."""
    return sorted(r.bucket for r in rows.select("bucket").distinct().collect())


def _known(rows: DataFrame, root: str, seen: Snapshot) -> DataFrame | None:
    """What is stored in the buckets of `rows`: a base is read by folder, deltas are small."""
    stored = stored_parts(rows.sparkSession, root, STATE, seen)
    return None if stored is None else stored.where(F.col("bucket").isin(touched_buckets(rows))).drop("batch")


def _in_buckets(combine: Combine, keys: list[str], buckets: int) -> Combine:
    """Combine rule of the stored form, which has a bucket and no order."""
    return lambda stored: combine(stored.drop("bucket", "batch")).withColumn("bucket", bucket_of(keys, buckets))


def update_states(reduced: DataFrame, root: str, batch_id: int, run: str, keys: list[str], combine: Combine,
                  buckets: int = 64, compact_every: int = 20) -> bool:
    """Merge a batch's reduced states (keys and states, see `Mergeable.reduce`) into the stored ones.
    Keys whose state stays as it was are not written again."""
    spark = reduced.sparkSession
    if is_done(spark, root, batch_id, run):
        return False
    seen = log.snapshot(spark, root)
    reduced = reduced.withColumn("bucket", bucket_of(keys, buckets)).persist()
    try:
        known = _known(reduced, root, seen)
        changed = reduced
        if known is not None:
            rule = _in_buckets(combine, keys, buckets)
            known = rule(known)
            changed = rule(known.unionByName(reduced)).subtract(known.select(reduced.columns))
        done = write_tables({STATE: changed}, root, batch_id, run)
    finally:
        reduced.unpersist()
    if len(seen.deltas(STATE)) + 1 >= compact_every:
        compact(spark, root, _in_buckets(combine, keys, buckets), STATE, ["bucket"])
    return done


def read_states(spark: SparkSession, root: str, keys: list[str], combine: Combine) -> DataFrame:
    return read_current(spark, root, lambda stored: combine(stored.drop("bucket", "batch")), STATE)


def _watermark(spark: SparkSession, root: str, delay: str, seen: Snapshot) -> Column | None:
    """Newest event time of all committed batches less `delay`."""
    clock = stored_parts(spark, root, CLOCK, seen)
    if clock is None:
        return None
    newest = clock.agg(F.max("at") - F.expr(f"INTERVAL {delay}")).first()[0]
    return None if newest is None else F.lit(newest)


def write_first(rows: DataFrame, root: str, batch_id: int, run: str, keys: list[str], time: str | None = None,
                delay: str = "10 minutes", buckets: int = 64, compact_every: int = 20) -> bool:
    """Add those rows of a batch to the output whose key has not been seen: of rows alike in their key the
    earliest (by `time`, then by all columns).

    With `time`, rows older than the watermark that the batches before left are late and dropped, and keys
    expire when the watermark passes their newest row: a key that comes back after that counts as new.
    Without it keys never expire.
    """
    spark = rows.sparkSession
    if is_done(spark, root, batch_id, run):
        return False
    seen = log.snapshot(spark, root)
    mark = _watermark(spark, root, delay, seen) if time else None
    at = F.col(time) if time else F.lit(None).cast("timestamp")
    fresh = rows if mark is None else rows.where(F.col(time).isNull() | (F.col(time) >= mark))
    # Of rows alike in their key one is enough: nothing below sees more of a batch than its keys.
    rest = sorted((c for c in rows.columns if c not in keys), key=lambda c: c != time)
    first = [F.min(F.struct(*[F.col(c).alias(f"_{c}") for c in rest])).alias("_r")] if rest else []
    reduced = (fresh.groupBy(*keys).agg(*first, F.max(at).alias("at"))
               .withColumn("bucket", bucket_of(keys, buckets)).persist())
    try:
        same = [F.col(k).alias(f"_{k}") for k in keys]
        known = _known(reduced, root, seen)
        new = reduced
        if known is not None:
            if mark is not None:
                known = known.where(F.col("at").isNull() | (F.col("at") >= mark))
            hit = F.lit(True)
            for k in keys:
                hit = hit & F.col(k).eqNullSafe(F.col(f"_{k}"))
            new = reduced.join(known.select(*same, F.col("bucket").alias("_b")),
                               hit & (F.col("bucket") == F.col("_b")), "left_anti")
        out = new.select(*[F.col(c) if c in keys else F.col(f"_r._{c}").alias(c) for c in rows.columns])
        state = reduced.select(*keys, "bucket", "at")
        clock = reduced.agg(F.max("at").alias("at"))
        done = write_tables({OUT: out, STATE: state, **({CLOCK: clock} if time else {})}, root, batch_id, run)
    finally:
        reduced.unpersist()
    if len(seen.deltas(STATE)) + 1 >= compact_every:
        expire(spark, root, keys, delay if time else None)
    return done


def expire(spark: SparkSession, root: str, keys: list[str], delay: str | None = "10 minutes") -> None:
    """Fold the state and leave out keys older than the watermark."""
    mark = _watermark(spark, root, delay, log.snapshot(spark, root)) if delay else None

    def rule(stored: DataFrame) -> DataFrame:
        newest = stored.groupBy(*keys, "bucket").agg(F.max("at").alias("at"))
        return newest if mark is None else newest.where(F.col("at").isNull() | (F.col("at") >= mark))

    compact(spark, root, rule, STATE, ["bucket"])
    if delay:
        compact(spark, root, lambda stored: stored.agg(F.max("at").alias("at")), CLOCK)
    compact(spark, root, None, OUT)


def read_first(spark: SparkSession, root: str) -> DataFrame:
    """All rows that were the first of their key."""
    return read_current(spark, root, lambda stored: stored, OUT)


def first_writer(root: str, keys: list[str], time: str | None = None, prepare: Callable = lambda batch: batch,
                 **settings) -> Callable[[DataFrame, int], None]:
    """Batch writer of `write_first` for `sinks.start_stream`."""
    return lambda batch, n: write_first(prepare(batch), root, n, run_of(batch), keys, time, **settings) and None


def state_writer(root: str, keys: list[str], combine: Combine, reduce: Callable, **settings) -> Callable[[DataFrame, int], None]:
    """Batch writer of `update_states`."""
    return lambda batch, n: update_states(reduce(batch), root, n, run_of(batch), keys, combine, **settings) and None
