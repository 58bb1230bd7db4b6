"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Equal vectors of a label are merged first, so exact copies cost one comparison.  Centres come from
spherical k-means on a bounded sample; their number follows the number of vectors.  Every vector is
at home in the cell of its nearest centre and visits the cells whose centre is almost as near: a
vector at cosine >= `limit` differs from it by at most sqrt(2 - 2 * limit) in length, so its nearest
centre can trail by no more than that times the centres' distance.  `reach` is the share of this
bound that is searched; 1.0 is exact, the default of one half loses a pair only if their
difference points straight along the line between two centres, which in d dimensions it does with a
spread of 1/sqrt(d).

A cell is cut into blocks of bounded size, rows at home and visitors apart, and each pair of blocks of which
one is at home is one group of work, so a cell with a third of all vectors is many groups, and its visitors,
which are most of its rows, never meet one another there.  A group returns per vector the number of vectors it links with and
links that connect what is connected within the group, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and
those with a null label, link with nothing; vectors of unlike length never link; rows that repeat an
id count as further vectors.  Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import NO_ID, components, pieces, row_id, stored
from vitrine.llm.vectors import clean, matrix, sample, usable

BLOCK = 1024


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Unit centres; an emptied cell restarts at the point farthest from its centre."""
    x = points / np.linalg.norm(points, axis=1, keepdims=True)
    centres = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = x @ centres.T
        cell = near.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        norms = np.linalg.norm(sums, axis=1)
        lost = norms < 1e-9
        if lost.any():
            sums[lost] = x[near.max(1).argsort()[:lost.sum()]]
            norms = np.linalg.norm(sums, axis=1)
        centres = sums / norms[:, None]
    return centres


def connect(linked: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Pairs (row, column) that join what a boolean block joins: a forest, found breadth first."""
    n, m = linked.shape
    nodes = n if same else n + m
    seen = np.zeros(nodes, bool)
    out = []
    for start in np.flatnonzero(linked.any(1)):
        if seen[start]:
            continue
        seen[start] = True
        queue = [int(start)]
        while queue:
            u = queue.pop()
            near = linked[u] if u < n else linked[:, u - n]
            found = np.flatnonzero(near)
            if not same and u < n:
                found = found + n
            for v in found[~seen[found]].tolist():
                seen[v] = True
                queue.append(v)
                a, b = (u, v) if u < n else (v, u)
                out.append((a, b if same else b - n))
    return out


def members(cells: list, homes: np.ndarray) -> np.ndarray:
    """Whether each row takes part in each of the given cells."""
    names, where = np.unique(homes, return_inverse=True)
    flat = np.concatenate([np.asarray(own, np.int64) for own in cells])
    row = np.repeat(np.arange(len(cells)), [len(own) for own in cells])
    place = np.minimum(np.searchsorted(names, flat), len(names) - 1)
    table = np.zeros((len(cells), len(names)), bool)
    some = names[place] == flat
    table[row[some], place[some]] = True
    return table[:, where]


def compare_blocks(group: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Links between two blocks of a cell, or within one: weights per node, and connecting pairs.

    A pair needs a row at home in the cell.  Where a row at home meets a visitor, the pair may meet
    in the visitor's home again: the smaller-named of the two homes has it if both take part there.
    """
    cell = int(group["cell"].iloc[0])
    same = int(group["i"].iloc[0]) == int(group["j"].iloc[0])
    left = group if same else group[group["own"] == group["i"]]
    right = left if same else group[group["own"] == group["j"]]
    if not len(left) or not len(right):
        return pd.DataFrame({"node": [], "links": [], "to": []})
    a, b = matrix(left["embedding"]), matrix(right["embedding"])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    linked = a @ b.T >= limit
    ha, hb = left["home"].to_numpy(), right["home"].to_numpy()
    home_a, home_b = (ha == cell)[:, None], (hb == cell)[None, :]
    mine = (hb[None, :] > cell) | ~members(list(left["cells"]), hb)
    theirs = (ha[:, None] > cell) | ~members(list(right["cells"]), ha).T
    linked &= (home_a & home_b) | (home_a & ~home_b & mine) | (~home_a & home_b & theirs)
    if same:
        np.fill_diagonal(linked, False)
    na, nb = left["node"].to_numpy(), right["node"].to_numpy()
    nodes, links = na, linked @ right["n"].to_numpy()
    if not same:
        nodes = np.concatenate([na, nb])
        links = np.concatenate([links, linked.T @ left["n"].to_numpy()])
    some = links > 0
    out = [pd.DataFrame({"node": nodes[some], "links": links[some], "to": nodes[some]})]
    pairs = np.array(connect(linked, same), np.int64).reshape(-1, 2)
    out.append(pd.DataFrame({"node": na[pairs[:, 0]], "links": 0, "to": nb[pairs[:, 1]]}))
    return pd.concat(out)


def deal(placed: DataFrame) -> DataFrame:
    """The rows of every pair of blocks (i, j) of a cell that is to be compared."""
    at_cell = placed.withColumn("cell", F.explode("cells")).withColumn("home", F.element_at("cells", 1))
    at_home = F.col("home") == F.col("cell")
    sizes = at_cell.groupBy("label", "cell").agg(
        F.ceil(F.count_if(at_home) / BLOCK).alias("homes"), F.ceil(F.count_if(~at_home) / BLOCK).alias("visits"))
    # A row goes to every pair of blocks that its own block is in: blocks at home come first, and
    # a pair without one is none.
    own = F.when(at_home, F.pmod(F.xxhash64("node"), F.col("homes"))).otherwise(
        F.col("homes") + F.pmod(F.xxhash64("node"), F.col("visits")))
    others = F.when(at_home, F.col("homes") + F.col("visits")).otherwise(F.col("homes"))
    return (at_cell.join(sizes, ["label", "cell"]).where("homes > 0").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
            .select("label", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    "own", "home", "cells", "node", "n", "embedding"))


def near_duplicates(vectors: DataFrame, limit: float = 0.93, cell_rows: int = 1500, reach: float = 0.5,
                    sample_rows: int = 20_000) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    spark = vectors.sparkSession
    rows = clean(vectors.where("label is not null"), ["label"]).withColumn("label", F.col("label").cast("string"))
    # One vector stands for all equal ones of its label, named by their smallest id.
    distinct = stored(rows.groupBy("label", "embedding").agg(F.min("id").alias("node"), F.count("*").alias("n")),
                      "distinct-vectors")
    total = distinct.count()
    fit = sample(distinct.select(F.col("node").alias("id"), "embedding"), sample_rows, total, 17)
    k = min(4096, max(1, len(fit) // 4), pieces(total, cell_rows))
    shared = spark.sparkContext.broadcast(spherical_kmeans(fit, k) if len(fit) else np.zeros((0, 0)))
    slack = reach * math.sqrt(max(0.0, 2 - 2 * limit))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for batch in batches:
            cells = []
            for e in batch["embedding"]:
                v = np.asarray(e, dtype=float)
                if not len(c) or len(v) != c.shape[1]:
                    cells.append([-len(v)])  # a cell for each other length
                    continue
                near = c @ (v / np.linalg.norm(v))
                home = int(near.argmax())
                gap = np.linalg.norm(c - c[home], axis=1)
                visits = np.flatnonzero(near[home] - near <= slack * gap)
                cells.append([home, *visits[visits != home].tolist()])
            batch["cells"] = cells
            yield batch

    placed = stored(distinct.mapInPandas(
        place, "label string, embedding array<double>, node long, n long, cells array<int>"), "placed")
    found = stored(deal(placed).groupBy("label", "cell", "i", "j").applyInPandas(
        lambda group: compare_blocks(group, limit), "node long, links long, to long"), "vector-links")
    component = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")), "vector-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (distinct.join(links, "node", "left").join(component, "node", "left")
             .select(F.col("label").alias("l"), F.col("embedding").alias("e"), "node",
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    linked = (rows.join(nodes, (rows["label"] == nodes["l"]) & (rows["embedding"] == nodes["e"]))
              .select("id", "n_links", "component_id"))
    alone = (vectors.where(~(usable() & F.col("label").isNotNull()))
             .select(row_id("vec_id").alias("id"), F.lit(0).cast("long").alias("n_links"),
                     row_id("vec_id").alias("component_id")))
    return linked.union(alone).select(
        F.nullif("id", F.lit(NO_ID)).alias("vec_id"), "n_links",
        F.nullif("component_id", F.lit(NO_ID)).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"))
