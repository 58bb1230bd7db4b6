"""Splitting heavy keys changes plans, never results."""

import datetime
import statistics

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import rows_of
from vitrine.operators.facts import build_fact_event
from vitrine.operators.skew import even_bands, heavy_keys, join_in_pieces, neighbour
from vitrine.plans import engagement, traffic


@pytest.fixture(scope="module")
def fact(lines):
    return build_fact_event(lines).cache()


@pytest.fixture(scope="module")
def lopsided(spark):
    """One key with most rows, many times tied, some in the same minute."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.timestamp_seconds(F.floor(F.col("id") * 7919 % 5000) * 11).alias("at"),
        F.col("id").cast("string").alias("name"))


def every_key(df, key):
    return heavy_keys(df, key, share=0.0, floor=0)


def test_heavy_keys_are_bounded_by_the_share(lopsided):
    heavy = {r.key: r._pieces for r in heavy_keys(lopsided, "key", share=0.1, floor=10).collect()}
    assert heavy == {"hot": 7}
    assert heavy_keys(lopsided, "key").count() == 0
    assert sum(r._pieces for r in heavy_keys(lopsided, "key", share=0.001, floor=0).collect()) <= 2 / 0.001


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("share", [0.0, 0.1])
@pytest.mark.parametrize("slice_seconds", [60, 5000])
def test_neighbour_equals_a_plain_window(lopsided, step, share, slice_seconds):
    pick = F.lead if step == 1 else F.lag
    plain = lopsided.withColumn("n", pick("name").over(Window.partitionBy("key").orderBy("at", "name")))
    ours = neighbour(lopsided, "key", "at", ["name"], {"name": F.col("name")}, step=step, into="near",
                     heavy=heavy_keys(lopsided, "key", share=share, floor=0), slice_seconds=slice_seconds)
    ours = ours.select("key", "at", "name", F.col("near.name").alias("n"))
    assert rows_of(ours) == rows_of(plain)
    known = neighbour(lopsided, "key", "at", ["name"], {"name": F.col("name")}, step=step, heavy=False)
    assert rows_of(known.select("key", "at", "name", F.col("near.name").alias("n"))) == rows_of(plain)


def test_join_in_pieces_equals_a_plain_join(spark, lopsided):
    small = lopsided.select("key").distinct().withColumn("x", F.length("key")).union(
        spark.createDataFrame([("hot", 99), ("absent", 1)], "key string, x int"))
    ours = join_in_pieces(lopsided, small, "key", every_key(lopsided, "key"), ["name"])
    assert rows_of(ours.select("key", "at", "name", "x")) == rows_of(lopsided.join(small, "key").select("key", "at", "name", "x"))


@pytest.mark.parametrize("rows", [0, 1, 3, 4, 10, 1001])
def test_even_bands_equal_ntile(spark, rows):
    df = spark.range(rows).select(F.col("id").cast("string").alias("who"), (F.col("id") * F.col("id") % 7).alias("n"))
    window = Window.orderBy("n", F.md5(F.col("who").cast("binary")), "who")
    plain = df.withColumn("band", F.ntile(4).over(window)).select("who", "n", "band")
    assert rows_of(even_bands(df, "n", "who", 4).select("who", "n", "band")) == rows_of(plain)


def test_durations_with_every_device_split(fact):
    plain = engagement.view_durations(fact).select("event_id", "view_ms")
    split = engagement.view_durations(fact, heavy=every_key(fact, "device_id")).select("event_id", "view_ms")
    assert rows_of(split) == rows_of(plain)


def test_attribution_with_every_device_split(fact):
    assert rows_of(traffic.touches(fact, share=0.0, floor=1)) == rows_of(traffic.touches(fact))


def test_medians(fact):
    """The exact median is that of all values; the approximate one is a middle value."""
    views = engagement.view_durations(fact)
    values = {}
    for row in views.where("view_ms IS NOT NULL").select("country_code", "view_ms").collect():
        values.setdefault(row.country_code, []).append(row.view_ms)
    exact = {r.country_code: r for r in engagement.duration_stats(views, ["country_code"]).collect()}
    near = {r.country_code: r for r in engagement.duration_stats(views, ["country_code"], approximate=True).collect()}
    assert exact.keys() == near.keys() == values.keys() and len(values) > 1
    for country, found in values.items():
        row, other = exact[country], near[country]
        assert row.median_ms == statistics.median(found)
        assert other.median_ms in (statistics.median_low(found), statistics.median_high(found))
        assert (row.timed_views, row.total_ms) == (other.timed_views, other.total_ms) == (len(found), sum(found))
        assert row.views == row.timed_views + row.open_views == other.views
        assert row.mean_ms == pytest.approx(other.mean_ms) == pytest.approx(sum(found) / len(found))


def test_gap_at_the_cap_counts_and_above_does_not(spark):
    start = datetime.datetime(2024, 1, 1)
    times = [0, 1800, 3601]
    fact = spark.createDataFrame(
        [(str(i), "d", start + datetime.timedelta(seconds=t), "view_product_detail") for i, t in enumerate(times)],
        "event_id string, device_id string, time_stamp timestamp, collection string")
    found = {r.event_id: r.view_ms for r in engagement.view_durations(fact, cap_ms=1_800_000).collect()}
    assert found == {"0": 1_800_000, "1": None, "2": None}
    found = {r.event_id: r.view_ms for r in engagement.view_durations(fact).collect()}
    assert found == {"0": 1_800_000, "1": 1_801_000, "2": None}
