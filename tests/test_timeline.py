"""The stored timeline and key summaries give what the whole fact table gives."""

import pytest
from pyspark.sql import Window, functions as F

from tests.conftest import SF, rows_of
from vitrine.checks import queries as q
from vitrine.operators import frequent, timeline
from vitrine.operators.skew import heavy_keys
from vitrine.plans import engagement


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    """One device with a third of all events over 30 days, many at equal times, some on the last second of
    a day; others with gaps of days, and events without device or time."""
    path = str(tmp_path_factory.mktemp("fact") / "fact")
    at = F.timestamp_seconds(1_704_067_200 + F.when(F.col("id") % 50 == 0, F.floor(F.col("id") / 200) % 30 * 86400 + 86399)
                             .otherwise(F.col("id") * 7919 % (30 * 86400)))
    rows = spark.range(6000).select(
        F.concat(F.lit("e"), F.col("id") % 5000).alias("event_id"),
        F.when(F.col("id") % 97 == 0, None).otherwise(at).alias("time_stamp"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 89 == 0, None)
        .otherwise(F.concat(F.lit("d"), F.col("id") % 700)).alias("device_id"),
        F.when(F.col("id") % 4 < 3, "view_product_detail").otherwise("purchase").alias("collection"),
        F.concat(F.lit("p"), F.col("id") % 11).alias("product_id"), F.lit("de").alias("country_code"),
        (F.col("id") % 2 == 0).alias("has_option"), F.lit("d1").alias("diamond_option_id"),
        F.lit(None).cast("string").alias("alloy_option_id"))
    rows = rows.withColumn("date_id", F.coalesce(F.date_format("time_stamp", "yyyyMMdd").cast("int"), F.lit(-1)))
    rows.write.partitionBy("date_id").parquet(path)
    return spark.read.parquet(path)


def both(views):
    return rows_of(views.select("event_id", "device_id", "view_ms", "product_id", "has_option"))


@pytest.mark.parametrize("floor", [10, 1_000_000])
def test_views_equal_those_of_the_fact_table(spark, fact, tmp_path, floor):
    timeline.refresh_timeline(fact, str(tmp_path), share=0.05, floor=floor)
    stored = timeline.read_timeline(spark, str(tmp_path))
    slices = stored.where("device_id = 'hot' and slice is not null").select("slice").distinct().count()
    assert slices > 1000 if floor == 10 else slices == 30
    assert both(timeline.timeline_views(stored)) == both(engagement.view_durations(fact))
    hour = 3_600_000
    assert both(timeline.timeline_views(stored, hour)) == both(engagement.view_durations(fact, hour))


def test_late_events_need_their_date_only(spark, fact, tmp_path):
    path, root = str(tmp_path / "fact"), str(tmp_path)
    late = F.col("event_id").substr(-1, 1) == "7"
    days = [r.date_id for r in fact.select("date_id").distinct().orderBy("date_id").collect()]
    fact.where(~late & (F.col("date_id") <= days[20])).write.partitionBy("date_id").parquet(path)
    timeline.refresh_timeline(spark.read.parquet(path), root)
    fact.where((late & F.col("date_id").isin(days[4:6])) | (F.col("date_id") > days[20])).write.mode("append").partitionBy(
        "date_id").parquet(path)
    now = spark.read.parquet(path)
    old = {n: t for n, t in files(tmp_path / "timeline")}
    timeline.refresh_timeline(now, root, days[4:6] + days[21:])
    assert both(timeline.timeline_views(timeline.read_timeline(spark, root))) == both(engagement.view_durations(now))
    assert sum(n in old for n, _ in files(tmp_path / "timeline")) == len(old) - 2
    timeline.refresh_timeline(now, root, days[4:6])  # again
    assert both(timeline.timeline_views(timeline.read_timeline(spark, root))) == both(engagement.view_durations(now))


def files(folder):
    return sorted((str(p), p.stat().st_mtime_ns) for p in folder.rglob("*.parquet"))


@pytest.mark.parametrize("name", ["view_duration", "view_duration_customising", "view_duration_option"])
def test_queries_order_no_events(spark, name):
    """Stored rows are scanned once, as views or as tails; the only window over rows is that of the tails, and
    the histogram is made once."""
    df = q.QUERIES[name](spark, SF)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert text.count("FileScan parquet") == 2 and text.count("ReusedExchange") >= 1 and "from_json" not in text
    assert text.count("Window [lead(first_at") == 1 and text.count("lead(") == 1
    assert text.count("functions=[partial_count(1)]") == 1


# --- frequent keys -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def days(spark):
    """Ten dates of very different sizes; keys that are frequent always, on one small date, and never."""
    rows = spark.range(20_000).select(F.floor(F.sqrt(F.col("id") / 200)).cast("int").alias("date_id"),
                                      F.col("id"), (F.col("id") * 7919 % 20_000).alias("x"))
    return rows.select("date_id", F.when(F.col("x") % 3 == 0, "always").when((F.col("date_id") == 0) & (F.col("x") % 2 == 0), "small")
                       .when(F.col("x") % 10 == 1, F.concat(F.lit("m"), F.col("x") % 3)).when(F.col("x") % 50 == 7, None)
                       .otherwise(F.concat(F.lit("k"), F.col("x") % 4000)).alias("a"), F.lit("one").alias("b")).cache()


@pytest.mark.parametrize("share", [0.3, 0.02, 0.001])
def test_merged_summaries_find_every_heavy_key(spark, days, tmp_path, share):
    path = str(tmp_path / "s")
    frequent.write_frequent_keys(days, ["a", "b"], path, share=share / 4)
    frequent.write_frequent_keys(days.where("date_id = 3"), ["a", "b"], path, share=share / 4)  # replaced, not added
    summaries = spark.read.parquet(path)
    for column in ("a", "b"):
        want = {r[column]: r._pieces for r in heavy_keys(days, column, share, 1).collect()}
        got = {r[column]: r._pieces for r in frequent.heavy_from_summaries(summaries, column, share, 1).collect()}
        assert want.items() and set(want) <= set(got) and len(got) <= 4 / 3 / share
        assert all(got[k] >= n for k, n in want.items())
    assert frequent.heavy_from_summaries(summaries, "a", share).count() == 0  # below the floor
    most = summaries.where("key is not null").groupBy("date_id", "key_name").count().agg(F.max("count")).first()[0]
    assert most <= 4 / share


def test_keys_are_not_counted_in_one_task(spark, tmp_path):
    """The stage that joins counts to bounds and filters them has a task for each shuffle partition."""
    rows = spark.range(4000).selectExpr("int(id % 4) AS date_id", "string(id) AS a")
    setting, sc = "spark.sql.adaptive.coalescePartitions.enabled", spark.sparkContext
    kept = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    sc.setJobGroup("frequent", "one write")
    try:
        frequent.write_frequent_keys(rows, ["a"], str(tmp_path / "k"))
    finally:
        spark.conf.set(setting, kept)
        sc.setJobGroup("", "")
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("frequent") for s in tracker.getJobInfo(j).stageIds]
    assert tracker.getStageInfo(max(stages)).numTasks > 1
    assert spark.read.parquet(str(tmp_path / "k")).where("key IS NOT NULL").count() == 4000


def test_heavy_devices_of_dates(spark, fact):
    found = frequent.frequent_keys(fact, ["device_id"])
    got = timeline.heavy_devices(found, 0.1, 10)
    counts = fact.where("device_id is not null").groupBy("date_id", "device_id").count()
    share = F.col("count") / F.sum("count").over(Window.partitionBy("date_id"))
    want = counts.withColumn("s", share).where("s > 0.1 and count > 10").select("date_id", "device_id")
    assert rows_of(got) == rows_of(want) and got.count() == 31


def test_summaries_of_an_empty_table(spark, days):
    none = frequent.frequent_keys(days.limit(0), ["a"])
    assert frequent.heavy_from_summaries(none, "a").collect() == []
