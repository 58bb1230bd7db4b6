"""A lattice of stored counts: every roll-up is answered from its smallest stored ancestor.

Counts add up, so a load adds the counts of its own rows as a delta of every stored node, all of them in
one entry of the commit log: a load that is repeated counts once, and no node is ever out of step with
another.  Within a load each node is made from its smallest finer node, so the events are counted once, at
the finest grain.  A query reads the node with the fewest rows that has its dimensions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.streaming import log
from vitrine.streaming.log import Snapshot
from vitrine.streaming.upsert import compact, is_done, read_current, write_tables

DIMENSIONS = ("date_id", "country_code", "store_id", "collection")
# Nodes worth storing: the finest, and coarser ones that queries begin from.
NODES = (DIMENSIONS, ("country_code", "store_id", "collection"), ("date_id", "country_code"), ("country_code", "collection"),
         ("store_id",), ())
SIZES = "sizes"


def node_name(dims: tuple[str, ...]) -> str:
    return "by_" + "_".join(d.split("_")[0] for d in dims) if dims else "total"


def _sum(rows: DataFrame, dims: tuple[str, ...] | list[str]) -> DataFrame:
    return rows.groupBy(*dims).agg(F.sum("n").alias("n"))


def _ancestor(dims: tuple[str, ...], nodes, size) -> tuple[str, ...]:
    return min((n for n in nodes if set(n) >= set(dims)), key=lambda n: (size(n), len(n)))


def add_counts(fact: DataFrame, root: str, batch_id: int, run: str, nodes: tuple = NODES) -> bool:
    """Count a load's rows into every node."""
    if is_done(fact.sparkSession, root, batch_id, run):
        return False
    finest = max(nodes, key=len)
    if any(not set(finest) >= set(n) for n in nodes):
        raise ValueError("one node must have all dimensions")
    made = {finest: fact.groupBy(*finest).agg(F.count(F.lit(1)).alias("n")).persist()}
    try:
        for dims in sorted(set(nodes) - {finest}, key=len, reverse=True):
            made[dims] = _sum(made[_ancestor(dims, made, len)], dims)
        sizes = [rows.agg(F.lit(node_name(d)).alias("node"), F.count(F.lit(1)).alias("rows")) for d, rows in made.items()]
        tables = {node_name(d): rows for d, rows in made.items()} | {SIZES: reduce(DataFrame.union, sizes)}
        return write_tables(tables, root, batch_id, run)
    finally:
        made[finest].unpersist()


def node_sizes(spark: SparkSession, root: str, seen: Snapshot) -> dict[str, int]:
    """Rows of each node, added up over the loads: one number per node."""
    whole = read_current(spark, root, lambda s: s.groupBy("node").agg(F.sum("rows").alias("rows")), SIZES, seen)
    return {r.node: r.rows for r in whole.collect()}


def counts_by(spark: SparkSession, root: str, by: list[str], nodes: tuple = NODES, where: Column | None = None,
              filters: tuple[str, ...] = (), seen: Snapshot | None = None, sizes: dict[str, int] | None = None) -> DataFrame:
    """Rows per group of `by`; `where` may read the dimensions `filters` as well."""
    seen = seen or log.snapshot(spark, root)
    sizes = sizes or node_sizes(spark, root, seen)
    dims = _ancestor((*by, *filters), nodes, lambda n: sizes[node_name(n)])
    rows = read_current(spark, root, lambda s: s.drop("batch"), node_name(dims), seen)
    return _sum(rows if where is None else rows.where(where), by)


def cube_counts(spark: SparkSession, root: str, by: list[str], nodes: tuple = NODES) -> DataFrame:
    """All groupings of `by` with their grouping id, as `cube` numbers them, each from its own ancestor."""
    seen = log.snapshot(spark, root)
    sizes, parts = node_sizes(spark, root, seen), []
    for level in range(1 << len(by)):
        kept = [c for i, c in enumerate(by) if not level >> (len(by) - 1 - i) & 1]
        rows = counts_by(spark, root, kept, nodes, seen=seen, sizes=sizes)
        parts.append(rows.select(*[F.col(c) if c in kept else F.lit(None).cast("string").alias(c) for c in by],
                                 F.lit(level).alias("level"), F.col("n").alias("events")))
    return reduce(DataFrame.unionByName, parts)


def fold_counts(spark: SparkSession, root: str, nodes: tuple = NODES) -> None:
    """Fold the deltas of all nodes."""
    for dims in nodes:
        compact(spark, root, lambda s, d=dims: _sum(s, d), node_name(dims))
    # A folded node has as many rows as groups, at most those of all loads.
    compact(spark, root, lambda s: s.groupBy("node").agg(F.sum("rows").alias("rows")), SIZES)
