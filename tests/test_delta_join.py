"""Rounds of a growing join equal one join of everything."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from vitrine.operators import delta_join as dj
from vitrine.operators.merge import merge_product_final
from vitrine.streaming import log


@pytest.fixture(scope="module")
def tables(spark):
    """Products with several collections, pages of several products, details that repeat, keys that are null or
    meet nothing."""
    products = spark.range(60).select(F.when(F.col("id") % 19 == 0, None).otherwise(F.concat(F.lit("p"), F.col("id") % 25)).alias("product_id"),
                                      F.concat(F.lit("c"), F.col("id")).alias("collection"), F.lit("d").alias("diamond_option_id"),
                                      F.lit("a").alias("alloy_option_id"))
    pages = spark.range(80).select(F.concat(F.lit("p"), F.col("id") % 30).alias("product_id"),
                                   F.when(F.col("id") % 23 == 0, None).otherwise(F.concat(F.lit("u"), F.col("id") % 33)).alias("current_url"),
                                   F.col("id").alias("n")).distinct()
    info = spark.range(50).select(F.concat(F.lit("n"), F.col("id")).alias("product_name"), F.lit("EUR 1").alias("price"),
                                  F.lit("x").alias("description"), F.concat(F.lit("u"), F.col("id") % 40).alias("current_url"))
    return [t.cache() for t in (products, pages, info)]


def parts(rows, n, of, salt):
    return rows.where(F.pmod(F.hash(*rows.columns, F.lit(salt)), F.lit(of)) == n)


@pytest.mark.parametrize("salt", [1, 2])
def test_rounds_equal_one_merge(spark, tables, tmp_path, salt):
    root = str(tmp_path / "m")
    for n in range(4):
        new = [parts(t, n, 4, salt + k) for k, t in enumerate(tables)]
        if n == 2:
            new[1] = new[1].limit(0)
        for _ in range(2):  # every round runs twice
            dj.merge_round(*new, root, n, "r", buckets=8, compact_every=3)
    products, pages, info = tables
    want = merge_product_final(products, pages.where(F.pmod(F.hash(*pages.columns, F.lit(salt + 1)), F.lit(4)) != 2), info)
    assert rows_of(dj.read_merged(spark, root)) == rows_of(want) and want.count() > 50


def test_old_rows_are_read_by_their_buckets(spark, tables, tmp_path):
    products, pages, info = tables
    root = str(tmp_path / "m")
    dj.merge_round(products.limit(0), pages, info, root, 0, "r", buckets=16)
    dj.fold_join(spark, f"{root}/pages")
    new = info.limit(1).withColumn("bucket", dj.bucket_of(["current_url"], 16))
    old = dj._old(spark, f"{root}/pages", dj.LEFT, log.snapshot(spark, f"{root}/pages"), dj.touched_buckets(new),
                  pages.withColumn("bucket", F.lit(0)).select("product_id", "current_url", "bucket"))
    assert "PartitionFilters: [isnotnull(bucket" in old._jdf.queryExecution().executedPlan().toString()
    assert 0 < old.count() < 40


def test_a_round_half_done_is_finished(spark, tables, tmp_path, monkeypatch):
    """A crash between the two joins: the round is run again and adds everything once."""
    root, (products, pages, info) = str(tmp_path / "m"), tables
    join = dj.join_round

    def crash(left, right, key, *args, **more):
        if key == "product_id":
            raise OSError("planned")
        return join(left, right, key, *args, **more)

    with monkeypatch.context() as broken:
        broken.setattr(dj, "join_round", crash)
        with pytest.raises(OSError):
            dj.merge_round(products, pages, info, root, 0, "r", buckets=4)
    dj.merge_round(products, pages, info, root, 0, "r", buckets=4)
    assert rows_of(dj.read_merged(spark, root)) == rows_of(merge_product_final(products, pages, info))
