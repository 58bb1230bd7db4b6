"""Idempotent incremental tables on plain parquet.

Every micro-batch writes its reduced rows to a folder of its own and becomes visible, for all tables at
once, by one entry in the commit log (`log`).  The first commit of a batch counts: a batch delivered
again is left out.  A run is a streaming query with its checkpoint: a new checkpoint starts a new run,
whose batch numbers begin again behind those of older ones.  A reader combines base and deltas by key;
`compact` folds them into a new base.  Writing costs what the batch costs: the table is never rewritten
per batch, and no listing grows with it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.streaming import log
from vitrine.streaming.log import RUN, Base, Snapshot

Combine = Callable[[DataFrame], DataFrame]

# Name of the table in a folder that holds only one.
ROWS = "rows"


def run_of(batch: DataFrame) -> str:
    """Name of the run that a micro-batch belongs to: the id its checkpoint keeps."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def write_tables(tables: dict[str, DataFrame], root: str, batch_id: int, run: str, at_once: int = 4) -> bool:
    """Write a batch's rows of several tables, `at_once` of them side by side, and commit them together.
    False: the batch is committed already, by an earlier attempt or by one that was faster."""
    spark = next(iter(tables.values())).sparkSession
    order = log.run_number(spark, root, run) * RUN + batch_id
    if is_done(spark, root, batch_id, run):
        return False
    attempt = uuid.uuid4().hex
    folders = {name: f"{name}/batch-{order:020d}-{attempt}" for name in tables}

    def store(name: str) -> None:
        tables[name].write.parquet(f"{root}/{folders[name]}")

    if len(tables) == 1:
        store(*tables)
    else:
        with ThreadPoolExecutor(at_once) as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(store), name) for name in tables]
            for job in jobs:
                job.result()
    if log.commit_batch(spark, root, order, folders):
        return True
    for folder in folders.values():
        log.delete(spark, f"{root}/{folder}")
    return False


def is_done(spark: SparkSession, root: str, batch_id: int, run: str) -> bool:
    """Whether a batch is committed: then its work can be left out."""
    return log.is_committed(spark, root, log.run_number(spark, root, run) * RUN + batch_id)


def write_delta(df: DataFrame, root: str, batch_id: int, run: str | None = None) -> bool:
    """The same for a folder with one table."""
    return write_tables({ROWS: df}, root, batch_id, run or run_of(df))


def stored_parts(spark: SparkSession, root: str, table: str = ROWS,
                 seen: Snapshot | None = None) -> DataFrame | None:
    """Newest base and the deltas it does not cover, with their order in `batch`."""
    seen = seen or log.snapshot(spark, root)
    base, deltas = seen.base(table), seen.deltas(table)
    parts = []
    if base:
        rows = spark.read.parquet(*[f"{root}/{p}" for p in base.paths])
        newest = F.lit(max(base.upto.values())).cast("bigint")
        parts.append(rows if "batch" in rows.columns else rows.withColumn("batch", newest))
    if deltas:
        order = F.regexp_extract(F.input_file_name(), r"/batch-([0-9]{20})-", 1).cast("bigint")
        parts.append(spark.read.parquet(*[f"{root}/{p}" for p in deltas.values()]).withColumn("batch", order))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_current(spark: SparkSession, root: str, combine: Combine, table: str = ROWS,
                 seen: Snapshot | None = None) -> DataFrame:
    stored = stored_parts(spark, root, table, seen)
    if stored is None:
        raise FileNotFoundError(f"nothing written to {root} yet")
    return combine(stored).drop("batch")


def newest(keys: list[str]) -> Combine:
    """Combine rule "the newest batch wins", for update-mode results."""
    def combine(stored: DataFrame) -> DataFrame:
        rest = [c for c in stored.columns if c not in keys]
        last = F.max_by(F.struct(*rest), "batch").alias("last")
        return stored.groupBy(*keys).agg(last).select(*keys, "last.*")

    return combine


def compact(spark: SparkSession, root: str, combine: Combine | None, table: str = ROWS,
            folders_by: list[str] | None = None) -> int:
    """Fold everything committed into a new base; returns its version.

    A rule that keeps `batch` keeps the order of single rows.  Without a rule the rows of the deltas are
    joined to the base as they are, and what the base holds is not written again.  `folders_by` cuts
    the base into folders by columns.  Readers switch to the base with its commit; of two compactions at
    once one is dropped.  Deltas that the base before it covered are deleted: a reader that started on
    that one has had a whole compaction to finish.
    """
    seen = log.snapshot(spark, root)
    old, deltas = seen.base(table), seen.deltas(table)
    if not deltas:
        return old.version if old else 0
    upto = dict(old.upto) if old else {}
    for order in deltas:
        upto[order // RUN] = max(order, upto.get(order // RUN, -1))
    version = old.version + 1 if old else 1
    path = f"{table}/base-{version:06d}-{uuid.uuid4().hex}"
    if combine is None:
        rows, kept = spark.read.parquet(*[f"{root}/{p}" for p in deltas.values()]), old.paths if old else []
    else:
        rows, kept = combine(stored_parts(spark, root, table, seen)), []
    writer = rows.write
    (writer.partitionBy(*folders_by) if folders_by else writer).parquet(f"{root}/{path}")
    if not log.commit_base(spark, root, table, Base(version, [*kept, path], upto)):
        log.delete(spark, f"{root}/{path}")
        return version
    _forget(spark, root, table, seen)
    return version


def _forget(spark: SparkSession, root: str, table: str, seen: Snapshot) -> None:
    """Delete what the base before the newest replaced: its deltas, bases older than it, and log entries
    of which no table needs its part any more."""
    old = seen.base(table)
    if old is None:
        return
    for order, parts in seen.batches.items():
        if not old.covers(order):
            continue
        if table in parts:
            log.delete(spark, f"{root}/{parts[table]}")
        if all(name == table or (name in seen.bases and any(b.covers(order) for b in seen.bases[name][:-1]))
               for name in parts):
            log.delete(spark, f"{root}/_log/batch-{order:020d}.json")
    for base in seen.bases[table][:-1]:
        log.delete(spark, f"{root}/_log/base-{table}-{base.version:06d}.json")
        for path in set(base.paths) - set(old.paths):
            log.delete(spark, f"{root}/{path}")


def remove_abandoned(spark: SparkSession, root: str, tables: list[str], older_hours: float = 24.0) -> list[str]:
    """Delete data folders that no entry names and that have not changed for `older_hours`: what writers
    that ended before their commit left.  Returns them."""
    before = time.time() - 3600 * older_hours
    found = [f"{table}/{name}" for table in tables for name, at in log.listed(spark, f"{root}/{table}").items()
             if name.startswith(("batch-", "base-")) and at <= before]
    # The log is read after the folders: what has been committed meanwhile is in it.
    seen = log.snapshot(spark, root)
    named = {p for parts in seen.batches.values() for p in parts.values()}
    named |= {p for bases in seen.bases.values() for b in bases for p in b.paths}
    gone = [f for f in found if f not in named]
    for folder in gone:
        log.delete(spark, f"{root}/{folder}")
    return gone
