"""Shared by the vector operators: usable vectors as bytes, distinct vectors, bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import row_id


def usable(name: str = "embedding") -> Column:
    """Not null, not empty, every component finite, not all zero."""
    x = F.col(name)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.size(x) > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True)) & F.exists(x, lambda v: v != 0)


def clean(vectors: DataFrame, extra: list[str]) -> DataFrame:
    """id, the extra columns and embedding (doubles) of the usable rows."""
    return vectors.where(usable()).select(
        row_id("vec_id").alias("id"), *extra, F.col("embedding").cast("array<double>").alias("embedding"))


def sample(vectors: DataFrame, rows: int, total: int, seed: int) -> np.ndarray:
    """About `rows` vectors chosen by the hash of their id, at most twice as many, as a matrix of
    those with the commonest length; repeatable."""
    if not total:
        return np.zeros((0, 0))
    pick = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30))
    got = (vectors.where(pick < int(min(1.0, 1.3 * rows / total) * (1 << 30)))
           .select("id", "embedding").limit(2 * rows).collect())
    if not got:
        got = vectors.select("id", "embedding").limit(rows).collect()
    found = [r["embedding"] for r in sorted(got, key=lambda r: r["id"])]
    lengths = [len(v) for v in found]
    most = max(set(lengths), key=lengths.count) if lengths else 0
    return np.array([v for v in found if len(v) == most], dtype=float).reshape(-1, most)


def matrix(column) -> np.ndarray:
    return np.array(list(column), dtype=float)
