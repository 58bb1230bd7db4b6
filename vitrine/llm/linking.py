"""From shared signatures to verified links, without all pairs of a group.

`members(sig, node)` names the nodes of every signature.  What callers need are the connected
components of the links among nodes that share a signature.  Testing every pair of a large group is
neither possible nor needed: once two nodes are known to be connected, their own link changes
nothing.  So pairs are tested in rounds:

1. every node of a group against the group's hub, the node that shares the most signatures with
   others: among copies of one text with edits of their own that is mostly the text itself;
2. while groups still span several components: the hub of each component in the group against the
   hub of all, and likewise the nodes that share least;
3. all pairs that share a group, lie in different components and were not tested before.

After step 3 each pair of nodes that shares a signature was tested, told apart by a bound that never
drops a link, or is connected, so the components are those of the full set of links.  All steps are
joins and aggregations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import components, stored

ROUNDS = 2


def _pairs(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def link_groups(members: DataFrame, verify: Callable[[DataFrame], DataFrame], label: str,
                plausible: DataFrame | None = None,
                condition: Callable[[str, str], F.Column] | None = None,
                sketches: DataFrame | None = None,
                similar: Callable[[str, str, str, str], F.Column] | None = None,
                rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(component of each linked node, verified links a < b).

    `verify` keeps the linked ones of distinct pairs (a, b).  `plausible(node, size)` with
    `condition(size column of a, size column of b)` drops pairs that cannot link before they are built.
    `sketches(node, bits)` with `similar(bits of a, bits of b, size of a, size of b)` drops them before they are
    verified; in step 3, where groups may have many pairs, every member carries its sketch, so that they are not
    built.  `rounds` is how often step 2 is repeated at most.
    """
    sized = sketches.join(plausible, "node") if sketches is not None else None
    if plausible is not None:
        members = members.join(plausible, "node")
    else:
        members = members.withColumn("size", F.lit(0).cast("long"))
    members = stored(members.select("sig", "node", "size"), label)
    # How often a node meets others; groups of one are left out here.
    met = members.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    members = members.join(met, "sig")
    shared = members.groupBy("node").agg((-F.sum("n")).alias("order"))
    members = stored(members.join(shared, "node").select("sig", "node", "size", "order"), label)

    def fits(pairs: DataFrame) -> DataFrame:
        return pairs.where(condition("s", "t")) if condition is not None else pairs

    def alike(pairs: DataFrame) -> DataFrame:
        if sized is None:
            return pairs
        one = sized.select(F.col("node").alias("a"), F.col("bits").alias("bx"), F.col("size").alias("s"))
        two = sized.select(F.col("node").alias("b"), F.col("bits").alias("by"), F.col("size").alias("t"))
        return pairs.join(one, "a").join(two, "b").where(similar("bx", "by", "s", "t")).select("a", "b")

    def tested(pairs: DataFrame, told: bool = False) -> tuple[DataFrame, DataFrame]:
        new = fits(pairs).select("a", "b").distinct()
        new = stored(new if told else alike(new), label)
        return new, stored(verify(new), label)

    # Step 1: each node against its group's hub.
    hub = members.groupBy("sig").agg(F.min(F.struct("order", "node", "size")).alias("h")).select(
        "sig", F.col("h.node").alias("hub"), F.col("h.size").alias("t"))
    done, links = tested(members.withColumnRenamed("size", "s").join(hub, "sig").where("node <> hub")
                         .select(*_pairs("node", "hub"), "s", "t"))
    for _ in range(rounds):
        component = components(links, label)
        placed = stored(members.join(component, "node", "left")
                        .withColumn("c", F.coalesce("component", "node")).drop("component"), label)
        split = (placed.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
                 .select("sig"))
        placed = stored(placed.join(split, "sig"), label)
        if placed.isEmpty():
            return component, links
        ends = placed.groupBy("sig", "c").agg(F.min(F.struct("order", "node", "size")).alias("x"),
                                              F.max(F.struct("order", "node", "size")).alias("z"))
        both = ends.select("sig", F.explode(F.array(F.struct(F.lit(0).alias("e"), F.col("x").alias("v")),
                                                    F.struct(F.lit(1).alias("e"), F.col("z").alias("v")))).alias("q"))
        both = both.select("sig", "q.e", F.col("q.v.order").alias("order"), F.col("q.v.node").alias("node"),
                           F.col("q.v.size").alias("s"))
        top = both.groupBy("sig", "e").agg(F.min(F.struct("order", "node", "s")).alias("h")).select(
            "sig", "e", F.col("h.node").alias("hub"), F.col("h.s").alias("t"))
        new = (both.join(top, ["sig", "e"]).where("node <> hub").select(*_pairs("node", "hub"), "s", "t")
               .join(done, ["a", "b"], "left_anti"))
        fresh, more = tested(new)
        if fresh.isEmpty():
            break
        done, links = done.union(fresh), links.union(more)
    component = components(links, label)
    placed = placed.drop("c").join(component, "node", "left").withColumn("c", F.coalesce("component", "node"))
    more = []
    if sketches is not None:
        placed, more = placed.join(sketches, "node"), ["bits"]
    left = placed.select("sig", F.col("node").alias("x"), F.col("c").alias("cx"), F.col("size").alias("s"),
                         *[F.col(c).alias("bx") for c in more])
    right = placed.select("sig", F.col("node").alias("y"), F.col("c").alias("cy"), F.col("size").alias("t"),
                          *[F.col(c).alias("by") for c in more])
    rest = left.join(right, "sig").where(F.col("cx") < F.col("cy"))
    if more:
        rest = rest.where(similar("bx", "by", "s", "t"))
    rest = fits(rest).select(*_pairs("x", "y"), "s", "t").join(done, ["a", "b"], "left_anti")
    _, more = tested(rest, told=sketches is not None)
    links = stored(links.union(more), label)
    return components(links, label), links
