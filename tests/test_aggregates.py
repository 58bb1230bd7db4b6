"""Stored sketches and counts against the fact table."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from vitrine.operators import device_sketches as ds, rollups
from vitrine.operators.facts import build_fact_event
from vitrine.plans import geography

CUBE = ["country_code", "store_id", "collection"]


@pytest.fixture(scope="module")
def fact(spark, lines):
    """The facts, with some nulls in every dimension."""
    rows = build_fact_event(lines, ["event_id", "date_id", "country_code", "store_id", "collection", "device_id"])
    odd = F.hash("event_id") % 17
    for n, c in enumerate(["country_code", "store_id", "collection", "device_id"]):
        rows = rows.withColumn(c, F.when(odd == n, None).otherwise(F.col(c)))
    return rows.cache()


def exact(fact, by):
    return rows_of(fact.where("device_id is not null").groupBy(*by).agg(F.countDistinct("device_id").alias("devices")))


def test_small_sets_are_exact(spark, fact, tmp_path):
    path = str(tmp_path / "s")
    ds.write_device_sketches(fact, path)
    ds.write_device_sketches(fact.where("date_id < 20240104"), path)  # again, replaced
    sketches = spark.read.parquet(path)
    for by in (["country_code"], ["country_code", "store_id"], ["date_id"]):
        assert rows_of(ds.device_counts(sketches, by)) == exact(fact, by)
    some = F.col("date_id").between(20240103, 20240109)
    assert rows_of(ds.device_counts(sketches.where(some), ["country_code"])) == exact(fact.where(some), ["country_code"])
    assert rows_of(ds.device_penetration(sketches)) == rows_of(geography.penetration(fact))
    seen = fact.where("device_id is not null and country_code is not null").select("country_code", "device_id").distinct()
    other = seen.select(F.col("country_code").alias("other_country"), "device_id")
    want = seen.join(other, "device_id").where("country_code < other_country").groupBy("country_code", "other_country").count()
    assert rows_of(ds.country_overlap(sketches)) == rows_of(want)


def test_large_sets_are_within_five_percent(spark, tmp_path):
    """Three countries of 60,000 to 100,000 devices, of which a third to a half are shared."""
    rows = spark.range(300_000).select(
        F.col("id").cast("string").alias("device_id"), (F.col("id") % 30).cast("int").alias("date_id"), F.lit("s").alias("store_id"),
        F.explode(F.filter(F.array(F.when(F.col("id") < 100_000, "de"), F.when(F.col("id").between(50_000, 139_999), "fr"),
                                   F.when(F.col("id").between(80_000, 299_999), "uk")), lambda c: c.isNotNull())).alias("country_code"))
    path = str(tmp_path / "s")
    ds.write_device_sketches(rows, path)
    sketches = spark.read.parquet(path)
    for r in ds.device_counts(sketches, ["country_code"]).collect():
        assert r.devices == pytest.approx({"de": 100_000, "fr": 90_000, "uk": 220_000}[r.country_code], rel=0.05)
    overlap = {(r.country, r.other_country): r.devices for r in ds.country_overlap(sketches).collect()}
    assert overlap.keys() == {("de", "fr"), ("de", "uk"), ("fr", "uk")}
    for pair, n in {("de", "fr"): 50_000, ("de", "uk"): 20_000, ("fr", "uk"): 60_000}.items():
        assert overlap[pair] == pytest.approx(n, rel=0.05 if n > 20_000 else 0.1)


def test_cube_from_stored_counts(spark, fact, tmp_path):
    root = str(tmp_path / "r")
    for n in range(3):
        assert rollups.add_counts(fact.where(F.pmod("date_id", F.lit(3)) == n), root, n, "load")
    assert not rollups.add_counts(fact, root, 1, "load")
    want = rows_of(geography.regional_cube(fact))
    assert rows_of(rollups.cube_counts(spark, root, CUBE)) == want
    rollups.fold_counts(spark, root)
    cube = rollups.cube_counts(spark, root, CUBE)
    assert rows_of(cube) == want
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan and "from_json" not in plan


def test_smallest_ancestor_is_read(spark, fact, tmp_path):
    root = str(tmp_path / "r")
    rollups.add_counts(fact, root, 0, "load")

    def read(by):
        return " ".join(rollups.counts_by(spark, root, by).inputFiles())

    assert "/total/" in read([]) and "/by_store/" in read(["store_id"])
    assert "/by_country_collection/" in read(["collection"]) and "/by_date_country/" in read(["date_id"])
    assert "/by_date_country_store_collection/" in read(["date_id", "store_id"])
    late = rollups.counts_by(spark, root, ["country_code"], where=F.col("date_id") > 20240110, filters=("date_id",))
    assert rows_of(late) == rows_of(fact.where("date_id > 20240110").groupBy("country_code").count())


def test_empty_load(spark, fact, tmp_path):
    root = str(tmp_path / "r")
    rollups.add_counts(fact.limit(0), root, 0, "load")
    assert rollups.counts_by(spark, root, ["store_id"]).collect() == []
