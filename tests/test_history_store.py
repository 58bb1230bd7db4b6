"""History from batches in any order equals the history of all versions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from vitrine.operators import history_store as hs
from vitrine.operators.history import product_history
from vitrine.streaming import log

START = datetime.datetime(2024, 1, 1)
SCHEMA = "product_id string, product_name string, raw_price string, seen_at timestamp"


def version(product, day, price, name="n"):
    return product, name, price, START + datetime.timedelta(days=day)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches(spark, tmp_path, seed):
    """Three products, values that come and go, equal times, late and repeated versions, nulls."""
    draw, root = random.Random(seed), str(tmp_path / "h")
    rows = [version(draw.choice("abc"), draw.randrange(12), draw.choice(["EUR 1", "EUR 2", None])) for _ in range(45)]
    rows += [version(None, 1, "x"), ("a", "n", "EUR 9", None)]
    draw.shuffle(rows)
    for n in range(5):
        hs.update_history(frame(spark, rows[9 * n:9 * n + 12]), root, n, "r", buckets=4, compact_every=3)
    want = rows_of(product_history(frame(spark, rows).distinct()))
    assert rows_of(hs.read_history(spark, root)) == want
    assert not hs.update_history(frame(spark, rows[:5]), root, 1, "r")  # delivered again
    hs.fold_history(spark, root)
    assert rows_of(hs.read_history(spark, root)) == want


def test_late_version_splits_and_merges(spark, tmp_path):
    root = str(tmp_path / "h")
    hs.update_history(frame(spark, [version("p", 1, "A"), version("p", 5, "A"), version("q", 1, "Z")]), root, 0, "r", 4)

    def spans():
        return [(r.raw_price, r.record_created_date.day, r.record_expired_date and r.record_expired_date.day)
                for r in hs.read_history(spark, root).where("product_id = 'p'").orderBy("record_created_date").collect()]

    assert spans() == [("A", 2, None)]
    hs.update_history(frame(spark, [version("p", 3, "B")]), root, 1, "r", 4)
    assert spans() == [("A", 2, 4), ("B", 4, 6), ("A", 6, None)]  # the second sight of A begins an interval
    hs.update_history(frame(spark, [version("p", 0, "B")]), root, 2, "r", 4)
    assert spans() == [("B", 1, 2), ("A", 2, 4), ("B", 4, 6), ("A", 6, None)]


def test_only_touched_products_are_written(spark, tmp_path):
    root = str(tmp_path / "h")
    hs.update_history(frame(spark, [version(f"p{i}", 1, "A") for i in range(60)]), root, 0, "r", 16)
    hs.fold_history(spark, root)
    hs.update_history(frame(spark, [version("p7", 2, "B"), version("p8", 1, "A")]), root, 1, "r", 16)
    delta = log.snapshot(spark, root).deltas(hs.SPANS)
    written = spark.read.parquet(*[f"{root}/{p}" for p in delta.values()])
    assert rows_of(written.select("product_id", "raw_price")) == [("p7", "A"), ("p7", "B")]
    assert hs.read_history(spark, root).where(F.col("is_current_record")).count() == 60
