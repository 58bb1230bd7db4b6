"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order in which it sees a set of pivots, nearest first.  Its row is
posted in the inverted files of its `posted` nearest pivots.  A query reads the files of its
`probed` nearest pivots, ranks what it finds there by the footrule distance of the two orders (sum
of the differences of pivot ranks), keeps the nearest share of each file and reranks those by
their exact inner product in double precision.  What lies as far as the last one kept stays too.

Equal vectors are merged before they are posted; each stands for its k + 1 smallest ids, of which an
answer never needs more.

Nearness is the inner product.  Vectors are lifted by one coordinate that makes their lengths equal
(queries by zero), after which the largest inner product is the nearest vector, as pivots assume.

Pivots are `pivots` distinct vectors of a bounded sample, in random order; all rows are indexed.  Files are cut into blocks of bounded size and
queries of a file into blocks as well; some blocks of each are one group of work, so a pivot near
to a third of all vectors is many groups.  Every group returns the `k` best per query.  A file
shorter than `least` is reranked whole, so small tables are answered exactly by all their rows.

Defined cases: vectors null, empty, zero or with null or non-finite components take no part;
vectors of a length other than the commonest are compared with those of their own length exactly;
ties go to the smaller id; rows that repeat an id are one candidate with their best score.  Rows without an
id cannot be named in an answer and take no part; any other id does, however small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from vitrine.llm.common import pieces, row_id, stored
from vitrine.llm.vectors import clean, matrix, sample

ROWS, JOINED, QUERIES = 4096, 4, 4096
BATCH = 1024


def orders(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's pivots by falling nearness, and the rank of each pivot."""
    near = points @ pivots.T - 0.5 * (pivots ** 2).sum(1)
    order = np.argsort(-near, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], 1)
    return order, rank


def footrule(rank: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Footrule distance of one order to many: sum over pivots of the rank differences.  `rank` has a row for each
    pivot; ranks are unsigned, a byte each where there are at most 256 pivots."""
    far = np.maximum(rank, wanted[:, None])
    far -= np.minimum(rank, wanted[:, None])
    return far.sum(0, dtype=np.uint16 if rank.itemsize == 1 else np.uint32)


def first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` ids with the best scores, ties to the smaller id, each id with its best."""
    some = np.arange(len(ids))
    if len(ids) > 4 * k:
        # All places up to a score; they are enough where they hold `k` ids.
        top = np.flatnonzero(score >= np.partition(score, len(ids) - 2 * k)[len(ids) - 2 * k])
        if len(np.unique(ids[top])) >= k:
            some = top
    best = some[np.lexsort((ids[some], -score[some]))]
    return best[np.sort(np.unique(ids[best], return_index=True)[1])[:k]]


def lift(points: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest ** 2 - (points ** 2).sum(1), 0.0))
    return np.hstack([points, rest[:, None]])


def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in pieces of at most BATCH rows."""
    for batch in batches:
        for lo in range(0, len(batch), BATCH):
            yield batch.iloc[lo:lo + BATCH].reset_index(drop=True)


def merged(rows: DataFrame, most: int) -> DataFrame:
    """id, ids and embedding of every distinct vector: its smallest id and its `most` smallest ones.
    A batch names a vector once, so a hot one meets as one row per batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts(batches):
            raw = [(np.asarray(e, dtype=float) + 0.0).tobytes() for e in batch["embedding"]]
            own = batch["id"].groupby(raw, sort=False)
            yield pd.DataFrame({"embedding": batch["embedding"].loc[own.head(1).index].tolist(),
                                "ids": [np.unique(g)[:most].tolist() for _, g in own]})

    some = rows.mapInPandas(run, "embedding array<double>, ids array<long>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most)
    return (some.groupBy("embedding").agg(ids.alias("ids"))
            .select(F.element_at("ids", 1).alias("id"), "ids", "embedding"))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, pivots: int = 128, posted: int = 8,
            probed: int = 24, share: float = 0.2, least: int = 512, sample_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id and score of the `k` nearest rows of each row with vec_id % every = 0."""
    spark = vectors.sparkSession
    rows = stored(clean(vectors.where(F.col("vec_id").isNotNull()), []), "ann-vectors")
    distinct = stored(merged(rows, k + 1), "ann-distinct")
    total = distinct.count()
    longest = float(rows.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v))).first()[0] or 0) ** 0.5
    found = sample(distinct, sample_rows, total, 23)
    # In an order that does not follow the ids, and no vector twice.
    found = np.unique(found, axis=0) if len(found) else found
    found = found[np.random.default_rng(23).permutation(len(found))[:pivots]]
    found = lift(found, longest) if len(found) else np.zeros((0, 1))
    shared = spark.sparkContext.broadcast(found)
    small = np.uint8 if len(found) <= 256 else np.uint16

    def post(files: int, query: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p = shared.value
            for batch in parts(batches):
                size = np.array([len(e) for e in batch["embedding"]], int)
                names = np.full(len(batch), None, object)
                ranks = np.full(len(batch), None, object)
                usual = size == p.shape[1] - 1
                if usual.any():
                    x = matrix(batch["embedding"][usual])
                    x = np.hstack([x, np.zeros((len(x), 1))]) if query else lift(x, longest)
                    order, rank = orders(x, p)
                    at = np.flatnonzero(usual)
                    for i, row in enumerate(at):
                        names[row] = order[i, :files].tolist()
                        ranks[row] = rank[i].astype(small).tobytes()
                for row in np.flatnonzero(~usual):
                    names[row], ranks[row] = [-int(size[row])], b""  # a file for each other length
                batch["files"], batch["ranks"] = names, ranks
                yield batch
        return run

    schema = "id long, ids array<long>, embedding array<double>, files array<int>, ranks binary"
    index = stored(distinct.mapInPandas(post(posted, False), schema), "ann-index")
    asked = stored(rows.where(F.col("id") % every == 0).select("id", F.array("id").alias("ids"), "embedding")
                   .mapInPandas(post(probed, True), schema), "ann-queries")
    # One row for each pivot and each other length; of the latter no table has more than the root of twice its numbers.
    cut = index.select(F.explode("files").alias("file")).groupBy("file").agg(F.ceil(F.count("*") / ROWS).alias("blocks"))
    cuts = (asked.select(F.explode("files").alias("file")).groupBy("file")
            .agg(F.ceil(F.count("*") / QUERIES).alias("asks")).join(cut, "file")
            .withColumn("groups", F.ceil(F.col("blocks") / JOINED)))
    cuts = F.broadcast(stored(cuts, "ann-cuts"))
    spread = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    posts = index.withColumn("file", F.explode("files")).join(cuts, "file").select(
        "file", F.floor(block / JOINED).alias("i"), spread("asks").alias("j"), block.alias("block"),
        F.lit(False).alias("ask"), "id", "ids", "embedding", "ranks")
    asks = asked.withColumn("file", F.explode("files")).join(cuts, "file").select(
        "file", spread("groups").alias("i"), F.pmod(F.xxhash64("id"), F.col("asks")).alias("j"),
        F.lit(-1).cast("long").alias("block"), F.lit(True).alias("ask"), "id", "ids", "embedding", "ranks")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        q, d = group[group["ask"]], group[~group["ask"]]
        if not len(q) or not len(d):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat([ranked(q, own) for _, own in d.groupby("block")])

    def ranked(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        """The `k` best of a block's rows per query."""
        x, ids = matrix(d["embedding"]), list(d["ids"])
        many = np.array([len(i) for i in ids])
        start, names = np.cumsum(many) - many, np.concatenate(ids)
        exact = int(d["file"].iloc[0]) < 0
        rank = None if exact else np.ascontiguousarray(np.array([np.frombuffer(r, small) for r in d["ranks"]]).T)
        askers, answers, scores = [], [], []
        keep = len(d) if exact else max(least, int(share * len(d)))
        for name, e, r in zip(q["id"], q["embedding"], q["ranks"]):
            near = np.arange(len(d))
            if keep < len(d):
                far = footrule(rank, np.frombuffer(r, small))
                near = np.flatnonzero(far <= np.partition(far, keep - 1)[keep - 1])
            score, n = x[near] @ np.asarray(e, dtype=float), many[near]
            # Every vector stands for all its ids.
            at = np.repeat(start[near] - np.cumsum(n) + n, n) + np.arange(n.sum())
            own, score = names[at], np.repeat(score, n)
            own, score = own[own != name], score[own != name]
            best = first(own, score, k)
            askers.append(np.full(len(best), name, np.int64))
            answers.append(own[best])
            scores.append(score[best])
        return pd.DataFrame({"query_id": np.concatenate(askers), "vec_id": np.concatenate(answers),
                             "score": np.concatenate(scores)})

    found = posts.union(asks).groupBy("file", "i", "j").applyInPandas(
        search, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
