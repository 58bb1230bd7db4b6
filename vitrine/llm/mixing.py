"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a share of all words.  A document of a source should then be taken target/size
times: the whole part always, the fraction by dependent rounding.  Two documents with fractions
`p` and `q` meet, and words move from one to the other at random, without changing either
expectation, until one fraction is 0 or 1; the other meets the next document.  The words of a
source are kept at every meeting, so its mix misses the target by less than one document.

Meetings form a reduction tree.  Documents are dealt by hash to leaves of bounded size, each leaf
leaves one open document per source, and the open ones of `fan_in` nodes meet one level up.  A
source that holds most rows has many leaves, like any other rows.  Each meeting draws its random
number from the hash of its two documents, so reruns and lost tasks repeat the same choices.

Defined cases: a null text has size 0 and no document of size 0 is ever taken; a null source is a
source of its own, last in order; rows alike in id, text and source are one unit that is taken
or left together, each row as often as the others.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import WORD, pieces, row_id, stored, whole_text

KEYS = ["id", "mark", "source"]


def words() -> Column:
    return F.regexp_count(whole_text(), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, target.  Weights repeat over the sources in code-point order, null last.

    Shares of all words by weight; what exceeds `most` times a source's size is shared again among
    the others by weight, until no target is above.  Every round aggregates the table of sources;
    only sums come back.  A round caps at least one more source or is the last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: the single ordered task sees source names and sums only.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    totals = stored(totals.select("source", "source_size", weight.cast("double").alias("weight")), "sources")
    cap = F.col("source_size") * most
    level, capped = 0.0, -1
    while True:
        over = cap <= F.col("weight") * level if capped >= 0 else F.lit(False)
        row = totals.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, cap)).alias("kept"),
                         F.sum(F.when(~over, F.col("weight"))).alias("open"),
                         F.count_if(over).alias("capped")).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped, level = row["capped"], ((row["all"] or 0) - (row["kept"] or 0)) / row["open"]
    return totals.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))


def _coin(a: str, b: str) -> float:
    return int.from_bytes(hashlib.blake2b(f"{a}|{b}".encode(), digest_size=7).digest(), "big") / float(1 << 56)


def meet(units: pd.DataFrame) -> pd.DataFrame:
    """Let the open units of one node and source meet in order of their marks."""
    units = units.sort_values(["rank", "id", "mark"], kind="stable").reset_index(drop=True)
    share = units["share"].to_numpy(copy=True)
    weight = units["weight"].to_numpy(dtype=float)
    names = [f"{i}:{m}" for i, m in zip(units["id"], units["mark"])]
    held = -1
    for i in range(len(share)):
        if not 0.0 < share[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        # Words that may move from b to a, and from a to b.
        up = min((1.0 - share[a]) * weight[a], share[b] * weight[b])
        down = min(share[a] * weight[a], (1.0 - share[b]) * weight[b])
        if _coin(names[a], names[b]) * (up + down) < down:
            full_a, full_b = up >= (1.0 - share[a]) * weight[a], up >= share[b] * weight[b]
            share[a] = 1.0 if full_a else share[a] + up / weight[a]
            share[b] = 0.0 if full_b else share[b] - up / weight[b]
        else:
            full_a, full_b = down >= share[a] * weight[a], down >= (1.0 - share[b]) * weight[b]
            share[a] = 0.0 if full_a else share[a] - down / weight[a]
            share[b] = 1.0 if full_b else share[b] + down / weight[b]
        held = next((k for k in (a, b) if 0.0 < share[k] < 1.0), -1)
    units["share"] = share
    return units


def copies(documents: DataFrame, leaf: int = 2000, fan_in: int = 64, seed: int = 11) -> DataFrame:
    """id, mark, source, size, source_size, target and copies, one row per distinct (id, text, source)."""
    rows = documents.select(row_id().alias("id"), F.xxhash64(F.col("text"), F.isnull("text")).alias("mark"),
                            "source", words().alias("size"))
    units = stored(rows.groupBy(*KEYS, "size").agg(F.count("*").alias("rows")), "mix-units")
    sizes = units.select("source", (F.col("size") * F.col("rows")).alias("size"))
    targets = source_targets(sizes)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A null source joins as well: null-safe equality.
    joined = units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")))
    start = joined.select("id", "mark", "u.source", "size", "rows", "source_size", "target",
                          F.floor(ratio).alias("whole"),
                          F.when(F.col("size") > 0, ratio - F.floor(ratio)).otherwise(0.0).alias("share"),
                          (F.col("size") * F.col("rows")).cast("double").alias("weight"),
                          F.xxhash64("id", "mark", F.lit(seed)).alias("rank"))
    nodes = pieces(units.count(), leaf)
    open_unit = F.col("share").between(1e-12, 1 - 1e-12)
    done = []
    level = stored(start.withColumn("node", F.pmod("rank", F.lit(nodes))), "mix-level")
    done.append(level.where(~open_unit))
    level = level.where(open_unit)
    while True:
        schema = level.schema
        level = stored(level.groupBy("source", "node").applyInPandas(meet, schema), "mix-level")
        done.append(level.where(~open_unit))
        if nodes == 1:
            break
        nodes = pieces(nodes, fan_in)
        level = level.where(open_unit).withColumn("node", F.pmod("node", F.lit(nodes)))
    last = level.where(open_unit)  # at most one unit of each source goes to its nearer side
    done.append(last.withColumn("share", F.round("share")))
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.select(*KEYS, "size", "source_size", "target",
                        F.when(F.col("size") > 0, F.col("whole") + F.round("share").cast("long"))
                        .otherwise(F.lit(0)).cast("long").alias("copies"))


def _marked(documents: DataFrame) -> DataFrame:
    return documents.withColumns({"__id": row_id(), "__mark": F.xxhash64(F.col("text"), F.isnull("text"))})


def _join(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    c = chosen.select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), F.col("source").alias("__source"),
                      F.col("copies").alias("__copies"))
    return documents.join(c, (documents["__id"] == c["__id"]) & (documents["__mark"] == c["__mark"])
                          & documents["source"].eqNullSafe(c["__source"])).drop(c["__id"]).drop(c["__mark"])


def mix(documents: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    names = documents.columns
    taken = _join(_marked(documents), copies(documents).where("copies > 0"))
    return taken.withColumn("__n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*names)


def mixture(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) and copies of every row."""
    rows = documents.select(row_id().alias("id"), F.xxhash64(F.col("text"), F.isnull("text")).alias("mark"),
                            "source", "doc_id")
    c = copies(documents)
    both = rows.alias("r").join(
        c.alias("c"), (F.col("r.id") == F.col("c.id")) & (F.col("r.mark") == F.col("c.mark"))
        & F.col("r.source").eqNullSafe(F.col("c.source")))
    return both.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "copies")
