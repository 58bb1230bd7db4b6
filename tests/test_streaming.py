"""Streams give what batches give, in any cut of the input, with replays and restarts."""

import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows_of
from vitrine.checks import fixtures as fx
from vitrine.operators.mergeable import TABLES
from vitrine.operators.parse import parse_events
from vitrine.operators.products import build_dim_product
from vitrine.sources.files import read_json_lines, stream_json_lines
from vitrine.streaming import jobs, log, sinks, upsert


@pytest.fixture(scope="module")
def folder(spark, lines, tmp_path_factory):
    """The click texts in six files."""
    path = str(tmp_path_factory.mktemp("lines") / "in")
    lines.repartition(6).write.text(path)
    return path


def test_table_definitions_merge_like_they_build(lines):
    for table in TABLES.values():
        events = parse_events(lines, table.fields)
        halves = table.reduce(events.where("hash(*) % 2 = 0")).unionByName(table.reduce(events.where("hash(*) % 2 <> 0")))
        whole = table.build(events)
        assert rows_of(table.finish(table.combine(halves.unionByName(halves)))) == rows_of(whole)


def test_warehouse_stream_equals_batch(spark, folder, tmp_path):
    root, lines = str(tmp_path / "w"), read_json_lines(spark, folder)
    stream = stream_json_lines(spark, folder, files_per_trigger=2)
    jobs.start_warehouse_stream(stream, root, f"{root}/cp", every=None).awaitTermination()
    for name, table in TABLES.items():
        batch = table.build(parse_events(lines, table.fields))
        assert rows_of(jobs.read_table(spark, root, name)) == rows_of(batch), name
        assert jobs.compact_table(spark, root, name) == 1
        assert rows_of(jobs.read_table(spark, root, name)) == rows_of(batch), name
    audit = jobs.read_audit(spark, root).agg(F.sum("rows"), F.count("*")).first()
    assert tuple(audit) == (lines.count(), 3)


def test_replayed_batch_and_restart_change_nothing(spark, lines, tmp_path):
    root, source = str(tmp_path / "w"), tmp_path / "in"
    texts = [r.json_str for r in lines.limit(300).collect()]
    source.mkdir()

    def put(name, part):
        (source / name).write_text("\n".join(part))

    def run():
        stream = stream_json_lines(spark, str(source), files_per_trigger=1)
        jobs.start_warehouse_stream(stream, root, f"{root}/cp", ["dim_product"], every=None).awaitTermination()

    put("a.txt", texts[:100])
    run()
    put("b.txt", texts[100:])
    run()
    table = TABLES["dim_product"]
    expected = rows_of(table.build(parse_events(read_json_lines(spark, str(source)), table.fields)))
    assert rows_of(jobs.read_table(spark, root, "dim_product")) == expected
    # The last batch is delivered a second time, as after a failure between sink and commit.
    write = jobs.warehouse_writer(root, ["dim_product"])
    again = read_json_lines(spark, str(source / "b.txt"))
    again.sparkSession.sparkContext.setLocalProperty("sql.streaming.queryId", stream_ids(spark, root)[0])
    try:
        write(again, 1)
    finally:
        again.sparkSession.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert len(stream_ids(spark, root)) == 1
    assert rows_of(jobs.read_table(spark, root, "dim_product")) == expected


def stream_ids(spark, root):
    return [json.loads(log.read_text(spark, f"{root}/_log/{n}"))["run"]
            for n in log.listed(spark, f"{root}/_log") if n.startswith("run-")]


def test_checkpoint_reset_after_compaction_loses_nothing(spark, tmp_path):
    """A new checkpoint counts its batches from 0 again; a second one before any compaction as well."""
    root, combine = str(tmp_path / "t"), upsert.newest(["k"])

    def row(key, value):
        return spark.createDataFrame([(key, value)], "k string, v string")

    for batch in (0, 1):
        upsert.write_delta(row(f"old{batch}", "a"), root, batch, "first")
    upsert.compact(spark, root, combine)
    upsert.write_delta(row("new", "b"), root, 0, "second")
    upsert.write_delta(row("old1", "c"), root, 0, "third")
    want = [("new", "b"), ("old0", "a"), ("old1", "c")]
    assert rows_of(upsert.read_current(spark, root, combine)) == want
    assert upsert.compact(spark, root, combine) == 2
    upsert.write_delta(row("late", "d"), root, 1, "second")
    assert rows_of(upsert.read_current(spark, root, combine)) == sorted([*want, ("late", "d")])
    runs = sorted(int(n[6:26]) // log.RUN for n in log.listed(spark, f"{root}/rows") if n.startswith("batch-"))
    assert runs == [2, 2, 3]  # the first run's rows are in the base that readers used before
    assert sorted(log.snapshot(spark, root).deltas("rows")) == [2 * log.RUN + 1]


def five_rows(spark, name):
    return spark.createDataFrame([(f"{name}{i}", name) for i in range(5)], "k string, v string")


def test_two_writers_at_once_lose_nothing(spark, tmp_path):
    """Runs that appear together, and writers that share a run and a batch."""
    for trial in range(3):
        root, start = str(tmp_path / f"t{trial}"), threading.Barrier(4)

        def write(name, run):
            start.wait()
            return upsert.write_delta(five_rows(spark, name), root, 0, run)

        with ThreadPoolExecutor(4) as pool:
            jobs_ = [pool.submit(write, *x) for x in (("a", "one"), ("b", "two"), ("c", "three"), ("c", "three"))]
            done = [j.result() for j in jobs_]
        assert done[0] and done[1] and sorted(done[2:]) == [False, True]
        assert rows_of(upsert.read_current(spark, root, upsert.newest(["k"]))) == sorted(
            (f"{n}{i}", n) for n in "abc" for i in range(5))
        assert sorted(stream_ids(spark, root)) == ["one", "three", "two"]


def test_create_absent_gives_a_name_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: log.create_absent(spark, f"{tmp_path}/l/x.json", str(i) * 5000), range(16)))
    assert sum(won) == 1 and log.read_text(spark, f"{tmp_path}/l/x.json") == str(won.index(True)) * 5000
    assert [n for n in log.listed(spark, f"{tmp_path}/l") if not n.endswith(".crc")] == ["x.json"]
    # The way of file systems without links.
    for want in (True, False):
        log._write(spark, f"{tmp_path}/l/draft", "y")
        assert log._take_rename(spark, f"{tmp_path}/l/draft", f"{tmp_path}/l/y.json") is want


def test_crashed_writer_is_not_read_and_is_retried(spark, tmp_path, monkeypatch):
    root, combine = str(tmp_path / "t"), upsert.newest(["k"])
    upsert.write_delta(five_rows(spark, "a"), root, 0, "r")

    def crash(*args):
        raise OSError("planned")

    with monkeypatch.context() as broken:
        broken.setattr(log, "commit_batch", crash)
        with pytest.raises(OSError):
            upsert.write_delta(five_rows(spark, "b"), root, 1, "r")
    assert upsert.read_current(spark, root, combine).count() == 5
    assert upsert.write_delta(five_rows(spark, "b"), root, 1, "r")
    assert not upsert.write_delta(five_rows(spark, "other"), root, 1, "r")  # delivered again
    assert upsert.read_current(spark, root, combine).count() == 10
    assert upsert.remove_abandoned(spark, root, ["rows"]) == []
    assert len(upsert.remove_abandoned(spark, root, ["rows"], older_hours=-1)) == 1
    assert upsert.read_current(spark, root, combine).count() == 10


def test_crash_between_tables_shows_none_of_them(spark, tmp_path):
    root = str(tmp_path / "w")
    upsert.write_tables({"x": five_rows(spark, "a"), "y": five_rows(spark, "b")}, root, 0, "r")
    bad = five_rows(spark, "c").withColumn("v", F.raise_error(F.lit("planned")).cast("string"))
    with pytest.raises(Exception, match="planned"):
        upsert.write_tables({"x": five_rows(spark, "c"), "y": bad}, root, 1, "r")
    for table in "xy":
        assert upsert.read_current(spark, root, lambda s: s, table).count() == 5


def test_reader_during_compaction(spark, tmp_path, monkeypatch):
    """A reader keeps its snapshot while bases are made and older ones go; a batch that commits meanwhile
    is in no base and not lost; of two compactions at once one counts."""
    root, combine = str(tmp_path / "t"), upsert.newest(["k"])
    for batch in (0, 1):
        upsert.write_delta(five_rows(spark, f"a{batch}"), root, batch, "r")
    early = upsert.read_current(spark, root, combine)
    assert upsert.compact(spark, root, combine) == 1
    assert early.count() == 10
    commit = log.commit_base

    def late(*args):
        upsert.write_delta(five_rows(spark, "late"), root, 3, "r")
        monkeypatch.setattr(log, "commit_base", commit)
        assert upsert.compact(spark, root, combine) == 2  # another compaction is faster
        return commit(*args)

    upsert.write_delta(five_rows(spark, "a2"), root, 2, "r")
    middle = upsert.read_current(spark, root, combine)
    monkeypatch.setattr(log, "commit_base", late)
    upsert.compact(spark, root, combine)
    assert middle.count() == 15 and upsert.read_current(spark, root, combine).count() == 20
    assert len([n for n in log.listed(spark, f"{root}/rows") if n.startswith("base-")]) == 2


def test_compaction_keeps_the_order_of_rows(spark, tmp_path):
    """A late batch of an older run is newer than that run's folded rows, and older than those of later runs."""
    root, combine = str(tmp_path / "t"), upsert.newest(["k"])

    def put(key, value, batch, run):
        upsert.write_delta(spark.createDataFrame([(key, value)], "k string, v string"), root, batch, run)

    put("x", "1", 0, "a"), put("y", "1", 0, "b"), put("z", "1", 0, "a2")
    upsert.compact(spark, root, combine)
    put("x", "2", 1, "a"), put("y", "2", 1, "a")
    assert rows_of(upsert.read_current(spark, root, combine)) == [("x", "2"), ("y", "1"), ("z", "1")]


def test_failure_of_any_stream_is_noticed(spark, folder, tmp_path):
    import time

    def fail(df, n):
        raise ValueError("planned")

    lines = stream_json_lines(spark, folder)
    going = sinks.start_stream(lines, lambda df, n: None, f"{tmp_path}/a", every="1 second")
    broken = sinks.start_stream(lines, fail, f"{tmp_path}/b", every="1 second")
    began = time.time()
    with pytest.raises(Exception, match="planned"):
        sinks.wait_for_all([going, broken])
    assert time.time() - began < 60 and not going.isActive


def test_windows_and_sessions_are_whole(spark, four_files, tmp_path):
    """Late events count and open windows appear, whatever the order of the files."""
    root = str(tmp_path / "out")
    parts = {"w": lambda b: jobs.view_parts(b, "10 minutes"), "s": jobs.session_parts}
    for name, reduce in parts.items():
        events = parse_events(stream_json_lines(spark, four_files, files_per_trigger=1),
                              ["_id", "time_stamp", "device_id", "collection"])
        sinks.start_stream(events, lambda df, n: upsert.write_delta(reduce(df), f"{root}/{name}", n, upsert.run_of(df)),
                           f"{root}/cp-{name}", every=None, skip_empty=True).awaitTermination()
    windows = upsert.read_current(spark, f"{root}/w", jobs.whole_windows)
    assert sorted((r.views, r.closed) for r in windows.collect()) == [(1, False), (3, True), (3, True)]
    sessions = upsert.read_current(spark, f"{root}/s", jobs.whole_sessions)
    assert sorted((r.events, r.closed) for r in sessions.collect()) == [(1, False), (3, True), (3, True)]


def test_empty_batches_are_not_written(spark, four_files, tmp_path):
    events = parse_events(stream_json_lines(spark, four_files), ["time_stamp", "collection"]).where("collection = 'none'")
    seen = []
    sinks.start_stream(events, lambda df, n: upsert.write_delta(df, f"{tmp_path}/t", n), f"{tmp_path}/cp", every=None,
                       report=lambda n, rows: seen.append(rows), skip_empty=True).awaitTermination()
    assert seen and not any(seen) and not log.listed(spark, f"{tmp_path}/t")


def test_complete_mode(spark, four_files, tmp_path):
    events = parse_events(stream_json_lines(spark, four_files, files_per_trigger=1), ["device_id", "_id"])
    counts = events.groupBy("device_id").count()
    sinks.start_stream(counts, lambda df, n: upsert.write_delta(df, f"{tmp_path}/t", n), f"{tmp_path}/cp", "complete",
                       every=None).awaitTermination()
    assert rows_of(upsert.read_current(spark, f"{tmp_path}/t", upsert.newest(["device_id"]))) == [("d", 7)]


def test_late_delta_after_compaction_is_merged(spark, tmp_path):
    root = str(tmp_path / "t")
    combine = upsert.newest(["k"])
    for batch, value in ((0, "a"), (1, "b")):
        upsert.write_delta(spark.createDataFrame([("x", value), (f"only{batch}", value)], "k string, v string"), root, batch)
    assert upsert.compact(spark, root, combine) == 1
    assert upsert.compact(spark, root, combine) == 1
    upsert.write_delta(spark.createDataFrame([("x", "c")], "k string, v string"), root, 2)
    assert rows_of(upsert.read_current(spark, root, combine)) == [("only0", "a"), ("only1", "b"), ("x", "c")]
    with pytest.raises(FileNotFoundError):
        upsert.read_current(spark, str(tmp_path / "none"), combine)


def test_update_mode_product_stream(spark, folder, tmp_path):
    root = str(tmp_path / "p")
    seen = []
    stream = build_dim_product(stream_json_lines(spark, folder, files_per_trigger=2))
    sinks.start_stream(stream, lambda df, n: upsert.write_delta(df, root, n), f"{root}/cp", "update",
                       every=None, report=lambda n, rows: seen.append(rows)).awaitTermination()
    current = upsert.read_current(spark, root, upsert.newest(["product_id", "collection"]))
    assert rows_of(current) == rows_of(build_dim_product(read_json_lines(spark, folder)))
    assert sum(seen) >= current.count() and len(seen) >= 3


def test_one_query_per_dimension(spark, folder, tmp_path):
    lines = read_json_lines(spark, folder)
    queries = jobs.start_dimension_streams(
        stream_json_lines(spark, folder), lambda name: lambda df, n: upsert.write_delta(df, f"{tmp_path}/{name}", n),
        f"{tmp_path}/cp", every=None)
    sinks.wait_for_all(queries)
    for name, (build, mode) in jobs.DIMENSIONS.items():
        stored = upsert.read_current(spark, f"{tmp_path}/{name}", lambda s: s.drop("batch"))
        assert rows_of(stored) == rows_of(build(lines)), name


def write_events(path, name, rows):
    (path / name).write_text("\n".join(json.dumps(
        {"_id": i, "time_stamp": t * 1000, "device_id": d, "collection": "view_product_detail"}) for i, t, d in rows))


@pytest.fixture
def four_files(tmp_path):
    """Files in order: noon, an hour later (one event twice), a little later, then a late event.
    A batch drops what is older than the watermark the batch before it started with."""
    path = tmp_path / "in"
    path.mkdir()
    base = 1_704_110_400
    write_events(path, "1.txt", [("a", base, "d"), ("b", base + 60, "d")])
    write_events(path, "2.txt", [("c", base + 3600, "d"), ("c", base + 3600, "d")])
    write_events(path, "3.txt", [("e", base + 3660, "d")])
    write_events(path, "4.txt", [("late", base + 120, "d"), ("z", base + 90_000, "d")])
    return str(path)


def run_windows(spark, path, build, tmp_path):
    # Files are taken oldest first; make their order plain.
    import os
    for n in (1, 2, 3, 4):
        os.utime(f"{path}/{n}.txt", (n * 1000, n * 1000))
    events = parse_events(stream_json_lines(spark, path, files_per_trigger=1), ["_id", "time_stamp", "device_id", "collection"])
    root = str(tmp_path / "out")
    sinks.start_stream(build(events), lambda df, n: upsert.write_delta(df, root, n), f"{root}/cp", every=None).awaitTermination()
    return upsert.read_current(spark, root, lambda s: s.drop("batch"))


def test_watermark_closes_windows_and_drops_late_events(spark, four_files, tmp_path):
    out = run_windows(spark, four_files, lambda e: jobs.windowed_views(e, "10 minutes"), tmp_path)
    assert sorted(r.views for r in out.collect()) == [2, 3]


def test_sessions_split_at_gaps(spark, four_files, tmp_path):
    out = run_windows(spark, four_files, lambda e: jobs.device_sessions(e, "30 minutes"), tmp_path)
    assert sorted(r.events for r in out.collect()) == [2, 3]


def test_duplicate_events_are_kept_once(spark, four_files, tmp_path):
    out = run_windows(spark, four_files, lambda e: jobs.first_events(e, ["_id"]), tmp_path)
    assert sorted(r._id for r in out.collect()) == ["a", "b", "c", "e", "z"]


def test_sinks_refuse_missing_checkpoint_and_unknown_mode(spark, folder):
    stream = stream_json_lines(spark, folder)
    with pytest.raises(ValueError):
        sinks.start_stream(stream, lambda df, n: None, "")
    with pytest.raises(ValueError):
        sinks.start_stream(stream, lambda df, n: None, "/tmp/x", "replace")


@pytest.fixture(scope="module")
def restless(spark):
    """A device with a third of all events, over 30 days with a rest now and then; events exactly a gap apart, at
    the edges of slices, at equal times, and without device or time."""
    at = F.floor(F.col("id") / 3) * 97 % 30 * 86400 + F.col("id") * 7919 % 50_000
    return spark.range(30_000).select(
        F.concat(F.lit("e"), "id").alias("_id"),
        F.when(F.col("id") % 997 == 0, None).otherwise(F.timestamp_seconds(1_704_067_200 + F.when(
            F.col("id") % 5 == 1, F.floor(F.col("id") / 100) * 1800).otherwise(at))).alias("time_stamp"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 991 == 0, None)
        .otherwise(F.concat(F.lit("d"), F.col("id") % 400)).alias("device_id")).cache()


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_sessions_equal_a_plain_window(spark, restless, block):
    from pyspark.sql import Window

    order = Window.partitionBy("device_id").orderBy("time_stamp", "_id")
    known = restless.where("device_id is not null and time_stamp is not null")
    gap = F.expr("INTERVAL 30 minutes")
    fresh = F.when(F.col("time_stamp") < F.lag("time_stamp").over(order) + gap, 0).otherwise(1)
    plain = (known.withColumn("n", fresh).withColumn("n", F.sum("n").over(order)).groupBy("device_id", "n")
             .agg(F.min("time_stamp").alias("a"), (F.max("time_stamp") + gap).alias("b"), F.count("*").alias("c")))
    parts = [jobs.session_parts(restless.where(F.pmod(F.hash("_id"), F.lit(3)) == n)) for n in range(3)]
    whole = jobs.whole_sessions(parts[0].unionByName(parts[1]).unionByName(parts[2]), block=block)
    ours = whole.select("device_id", "session_start", "session_end", "events")
    assert rows_of(ours) == rows_of(plain.select("device_id", "a", "b", "c"))
    assert plain.where("device_id = 'hot'").count() > 20 and plain.count() > 5000


def test_hot_device_is_many_tasks(spark, restless):
    """What a task orders is a block of a device's slices, and slices are counted before they move."""
    whole = jobs.whole_sessions(jobs.session_parts(restless), block=48)
    text = whole._jdf.queryExecution().executedPlan().toString()
    assert "session_window" not in text and "MergingSessions" not in text and "UpdatingSessions" not in text
    windows = [x for x in text.splitlines() if "Window [" in x]
    assert windows and all("block" in x for x in windows)
    blocks = restless.where("device_id = 'hot'").select(F.floor(F.unix_seconds("time_stamp") / 1800 / 48).alias("b"))
    assert blocks.distinct().count() >= 26


def test_each_batch_of_a_dealt_stream_is_read_by_several_tasks(spark, tmp_path):
    seen = []
    stream = fx.click_stream(spark, SF, batches=2)
    sinks.start_stream(stream, lambda batch, n: seen.append((batch.rdd.getNumPartitions(), batch.count())),
                       str(tmp_path / "c"), every=None).awaitTermination()
    assert len(seen) == 2 and all(tasks > 1 for tasks, _ in seen)
    assert sum(rows for _, rows in seen) == fx.table(spark, SF, "events").count()
