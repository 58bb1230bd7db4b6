"""Merkle manifest of a dataset: proofs of single rows, stored in van Emde Boas layout.

Every row is a leaf, H of its fields; H is sha256 in lower-case hex over the concatenated inputs.  The
rows of one language form a tree, whose leaves ascend by id; on each level every two neighbours become
their H, and a node without a neighbour becomes the H of itself alone.  The subroots of the
languages, null first and then bytewise, form one more tree in the same way.

Trees are cut into aligned blocks of `height` levels.  A block stores its digests in van Emde Boas
order: a tree of L levels is a top tree of L // 2 levels, then its bottom trees, each laid out alike.
`addresses` finds a node's place by arithmetic over one small table per depth, for construction and for
the siblings of a path alike.  The roots of a level's blocks are the leaves of the next level's
blocks, until one block per tree is left; proofs come down the same way, every block adding its
siblings to those above.  A task holds one block; the driver gets the root and row counts.

Places are dense ranks: leaves (not texts) are range-partitioned by language and id, and counts per part
give each part its first place, so a language with most of the rows is spread.

Defined cases: a null field is `-` and differs from an empty one; a null language is a tree of its
own, before the empty one; null ids come first; rows with one id ascend by leaf, equal rows are
leaves of their own; a single row's leaf is its subroot, a single subroot the root; an empty table
has no root and gives no rows; other columns play no part.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import pieces, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


# --- the layout ------------------------------------------------------------------------------

@functools.lru_cache(64)
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """Per depth from the root: the place of each node, from left to right, of a complete tree with
    `height` levels below its root.

    For the depth at which a recursive split puts the roots of bottom trees: the depth of the top
    tree's root, the top tree's size and a bottom tree's size.  A node's low path bits say which
    bottom tree it starts.
    """
    table: dict[int, tuple[int, int, int]] = {}

    def split(first: int, levels: int) -> None:
        if levels > 1:
            top = levels // 2
            table[first + top] = (first, (1 << top) - 1, (1 << (levels - top)) - 1)
            split(first, top)
            split(first + top, levels - top)

    split(0, height + 1)
    found = [np.zeros(1, np.int64)]
    for depth in range(1, height + 1):
        above, top, bottom = table[depth]
        path = np.arange(1 << depth, dtype=np.int64)
        found.append(found[above][path >> (depth - above)] + top + (path & top) * bottom)
    return tuple(found)


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def build_block(leaves: list[str], height: int) -> bytes:
    """Digests of an aligned subtree over at most 2 ** height neighbours; places without a node are zero."""
    where = addresses(height)
    out = bytearray(DIGEST * ((2 << height) - 1))
    now = leaves
    for depth in range(height, -1, -1):
        for place, node in zip(where[depth].tolist(), now):
            out[DIGEST * place:DIGEST * (place + 1)] = bytes.fromhex(node)
        now = [digest(*now[i:i + 2]) for i in range(0, len(now), 2)]
    return bytes(out)


def path_steps(store: bytes, count: int, height: int, place: int) -> list[str]:
    """Siblings of a leaf's path up to the block's root: the side, `l` or `r`, and the digest; a node
    without a sibling gives an empty step."""
    where, steps = addresses(height), []
    for depth in range(height, 0, -1):
        other = place ^ 1
        if other < count:
            at = DIGEST * int(where[depth][other])
            steps.append(("r" if other > place else "l") + store[at:at + DIGEST].hex())
        else:
            steps.append("")
        place, count = place >> 1, (count + 1) >> 1
    return steps


def fold(leaf: str, steps: list[str]) -> str:
    """The root that a leaf and the siblings of its path lead to."""
    for step in steps:
        leaf = digest(step[1:], leaf) if step[:1] == "l" else digest(leaf, step[1:])
    return leaf


# --- the manifest ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    """Blocks of the languages' trees and of the tree over their subroots, lowest level first."""
    leaves: DataFrame  # tree, pos, size, doc_id, digest, changed
    height: int
    levels: list[DataFrame]  # tree, block, size, count, height, store
    subroots: DataFrame  # tree, pos, size, name (the language's tree), digest
    top: list[DataFrame]
    root: str | None


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """The leaf digest of a row, with some fields replaced."""
    return F.sha2(F.concat(*[field(changed.get(f, F.col(f))) for f in FIELDS]), 256)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows`, a stored table, with their place `pos` (from 0) among those of their tree, and its `size`."""
    columns = rows.columns
    # The row number spreads rows that are alike in everything else.
    dealt = (rows.withColumn("_row", F.monotonically_increasing_id())
             .repartitionByRange(pieces(rows.count(), 100_000), "tree", *order, "_row")
             .sortWithinPartitions("tree", *order, "_row")
             .select(*columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    dealt = stored(dealt, "merkle")
    runs = dealt.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "_part", F.sum("_n").over(tree).alias("size"),
                       (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return (dealt.join(runs, ["tree", "_part"])
            .select(*columns, (F.col("_at") + F.col("_shift")).alias("pos"), "size"))


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """Blocks over one level's nodes (tree, pos, size, digest)."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        leaves = table.sort_by("pos").column("digest").to_pylist()
        size = table.column("size")[0].as_py()
        own = min(height, (size - 1).bit_length())
        return pa.table({"tree": [key[0].as_py()], "block": [key[1].as_py()], "size": [size], "count": [len(leaves)],
                         "height": pa.array([own], pa.int32()),
                         "store": pa.array([build_block(leaves, own)], pa.binary())})

    return (nodes.select("tree", (F.shiftright("pos", height)).alias("block"), "pos", "size", "digest")
            .groupBy("tree", "block")
            .applyInArrow(run, "tree string, block long, size long, count long, height int, store binary"))


def _tree_levels(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of blocks over `nodes`, and the digest that remains of every tree."""
    root = F.lower(F.hex(F.substring("store", 1, DIGEST))).alias("digest")
    levels, roots = [], []
    while True:
        level = stored(_blocks(nodes, height), "merkle")
        levels.append(level)
        roots.append(level.where(F.col("size") <= 1 << height).select("tree", root))
        nodes = level.where(F.col("size") > 1 << height).select(
            "tree", F.col("block").alias("pos"),
            F.shiftright(F.col("size") + ((1 << height) - 1), height).alias("size"), root)
        if nodes.isEmpty():
            return levels, functools.reduce(DataFrame.union, roots)


def build(documents: DataFrame, height: int = 10, **changed: Column) -> Manifest:
    """The manifest of `documents`.  Fields given as columns are those of a later state of the rows, of
    which only the leaf `changed` (null: unchanged) is kept, for `proofs` to check."""
    leaf, later = leaf_of(), leaf_of(**changed)
    rows = stored(documents.select(*FIELDS).select(
        # Sorts a null language before the empty one, and the others bytewise.
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf.alias("digest"), (F.nullif(later, leaf) if changed else F.lit(None).cast("string")).alias("changed")),
        "merkle")
    leaves = stored(placed(rows, ["doc_id", "digest"]), "merkle")
    levels, roots = _tree_levels(leaves, height)
    roots = stored(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "merkle")
    subroots = stored(placed(roots, ["name"]), "merkle")
    if subroots.isEmpty():
        return Manifest(leaves, height, levels, subroots, [], None)
    top, root = _tree_levels(subroots, height)
    return Manifest(leaves, height, levels, subroots, top, root.first()["digest"])


STEPS = "steps array<string>, subroot string"


def _at_blocks(level: DataFrame, height: int, tops: DataFrame, below: DataFrame | None) -> DataFrame:
    """A level's blocks with the steps above their roots: those of the tree's root for a tree's last
    block, else what the level above found for the block's root."""
    above = level.where(F.col("size") <= 1 << height).select("tree", "block").join(tops, "tree")
    if below is not None:
        above = above.unionByName(below.withColumnRenamed("pos", "block"))
    return level.join(above, ["tree", "block"])


def _down(levels: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The lowest level's blocks with the steps above their roots; `tops` (tree, steps, subroot)."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        first, own = row["block"] << height, range(row["count"])
        steps = [path_steps(row["store"], row["count"], row["height"], i) + row["steps"] for i in own]
        return pa.table({"tree": [row["tree"]] * len(own), "pos": pa.array([first + i for i in own], pa.int64()),
                         "steps": pa.array(steps, pa.list_(pa.string())),
                         "subroot": pa.array([row["subroot"]] * len(own), pa.string())})

    below = None
    for level in levels[:0:-1]:
        at = _at_blocks(level, height, tops, below)
        below = stored(at.groupBy("tree", "block").applyInArrow(run, f"tree string, pos long, {STEPS}"), "merkle")
    return _at_blocks(levels[0], height, tops, below)


def _proven(nodes: DataFrame, blocks: DataFrame, height: int, run, schema: str) -> DataFrame:
    """Meet every lowest node with its block."""
    keyed = nodes.withColumn("block", F.shiftright("pos", height))
    return (keyed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
            .applyInArrow(lambda left, right: run(left, right.to_pylist()[0]), schema))


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 (H of the path's siblings), folded_root (from the changed
    leaf where there is one) and verified (that is the root) of every row."""
    height, root = manifest.height, manifest.root
    mask = (1 << height) - 1
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    if root is None:
        return manifest.leaves.sparkSession.createDataFrame([], schema)

    def to_top(left: pa.Table, block: dict) -> pa.Table:
        steps = [path_steps(block["store"], block["count"], block["height"], pos & mask) + block["steps"]
                 for pos in left.column("pos").to_pylist()]
        return pa.table({"tree": left.column("name"), "steps": pa.array(steps, pa.list_(pa.string())),
                         "subroot": left.column("digest")})

    def to_root(left: pa.Table, block: dict) -> pa.Table:
        found: dict[str, list] = {n: [] for n in ("proof_sha256", "folded_root", "verified")}
        for pos, leaf, changed in zip(*[left.column(c).to_pylist() for c in ("pos", "digest", "changed")]):
            steps = path_steps(block["store"], block["count"], block["height"], pos & mask) + block["steps"]
            found["proof_sha256"].append(digest(*[s[1:] for s in steps]))
            found["folded_root"].append(fold(changed or leaf, steps))
            found["verified"].append(found["folded_root"][-1] == root)
        n = left.num_rows
        return pa.table({"doc_id": left.column("doc_id"), "leaf": left.column("digest"),
                         "subroot": pa.array([block["subroot"]] * n, pa.string()),
                         "root": pa.array([root] * n, pa.string()),
                         "proof_sha256": pa.array(found["proof_sha256"], pa.string()),
                         "folded_root": pa.array(found["folded_root"], pa.string()),
                         "verified": pa.array(found["verified"], pa.bool_())})

    none = manifest.leaves.sparkSession.createDataFrame([("", [], "")], f"tree string, {STEPS}")
    tops = stored(_proven(manifest.subroots, _down(manifest.top, none, height), height, to_top,
                          f"tree string, {STEPS}"), "merkle")
    blocks = _down(manifest.levels, tops, height)
    return _proven(manifest.leaves, blocks, height, to_root, schema)


def tamper_check(documents: DataFrame, height: int = 10) -> DataFrame:
    """Proofs of all rows after n_chars went up by one in those whose id's crc32 is divisible by 7."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = F.when(chosen, more).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    return proofs(build(documents, height, n_chars=changed))
