"""Stream state in buckets: whole results, bounded state, replays that change nothing."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from vitrine.operators.devices import build_dim_device
from vitrine.operators.mergeable import TABLES
from vitrine.operators.parse import parse_events
from vitrine.sources.files import read_json_lines, stream_json_lines
from vitrine.streaming import log, sinks, state, upsert

START = datetime.datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp, v int"


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def put(spark, root, batch, rows, run="r", **settings):
    settings = {"time": "at", "delay": "10 minutes", "buckets": 4, "compact_every": 4, **settings}
    return state.write_first(spark.createDataFrame(rows, SCHEMA), root, batch, run, ["k"], **settings)


def test_state_stays_bounded_over_many_batches(spark, tmp_path):
    """Twenty batches of fresh keys and repeated ones: the output has each once, the state holds what the delay
    and the batches between two compactions reach."""
    root, sizes, folders = str(tmp_path / "s"), [], []
    for n in range(20):
        rows = [(f"k{10 * n + i}", at(10 * n + i), n) for i in range(10)]
        again = [(f"k{10 * n - 1}", at(10 * n + 1), 99)] if n else []  # seen in the batch before
        assert put(spark, root, n, rows + again + rows[:1])
        if n % 4 == 2:  # just before the state is folded
            sizes.append(upsert.stored_parts(spark, root, state.STATE).select("k").distinct().count())
        folders.append(len(log.listed(spark, f"{root}/_log")))
    out = state.read_first(spark, root)
    assert rows_of(out.select("k", "v")) == sorted((f"k{10 * n + i}", n) for n in range(20) for i in range(10))
    assert max(sizes) <= 65 and sizes[-1] <= sizes[1] + 1
    assert max(folders) <= 20  # the log is folded as well
    bases = [n for n in log.listed(spark, f"{root}/state") if n.startswith("base-")]
    assert len(bases) == 2 and any(n.startswith("bucket=") for n in os.listdir(f"{root}/state/{bases[0]}"))


def test_late_and_returning_keys(spark, tmp_path):
    root = str(tmp_path / "s")
    put(spark, root, 0, [("a", at(0), 1), ("b", at(30), 1), (None, at(30), 1)])
    put(spark, root, 1, [("late", at(19), 2), ("intime", at(20), 2), ("b", at(31), 2), (None, at(31), 2), ("untimed", None, 2)])
    put(spark, root, 2, [("a", at(60), 3), ("b", at(41), 3), ("untimed", None, 3)])  # "a" expired, "b" not
    put(spark, root, 3, [("b", at(52), 4)])  # seen last at 41, the watermark is at 50: new, as after any expiry
    assert rows_of(state.read_first(spark, root).select("k", "v")) == sorted(
        [("a", 1), ("a", 3), ("b", 1), ("b", 4), (None, 1), ("intime", 2), ("untimed", 2)], key=repr)


def test_replay_and_crash(spark, tmp_path, monkeypatch):
    root, rows = str(tmp_path / "s"), [("a", at(0), 1), ("b", at(1), 1)]
    assert put(spark, root, 0, rows) and not put(spark, root, 0, rows)

    def crash(*args):
        raise OSError("planned")

    with monkeypatch.context() as broken:
        broken.setattr(log, "commit_batch", crash)
        with pytest.raises(OSError):
            put(spark, root, 1, [("c", at(2), 2), ("a", at(2), 2)])
    assert put(spark, root, 1, [("c", at(2), 2), ("a", at(2), 2)])
    assert rows_of(state.read_first(spark, root).select("k", "v")) == [("a", 1), ("b", 1), ("c", 2)]


def test_batches_read_their_buckets_only(spark, tmp_path):
    root = str(tmp_path / "s")
    put(spark, root, 0, [(f"k{i}", at(i % 5), 0) for i in range(300)], buckets=16, compact_every=1)
    seen = log.snapshot(spark, root)
    rows = spark.createDataFrame([("k7", at(1), 1)], SCHEMA).withColumn("bucket", state.bucket_of(["k"], 16))
    known = state._known(rows, root, seen)
    assert 0 < known.count() < 60
    assert "PartitionFilters: [isnotnull(bucket" in known._jdf.queryExecution().executedPlan().toString()


def test_only_changed_states_are_written(spark, lines, tmp_path):
    """The update-mode product table from its mergeable states, in batches and with a batch repeated."""
    table, root = TABLES["dim_product"], str(tmp_path / "p")
    events = parse_events(lines, table.fields).withColumn("part", F.pmod(F.hash("_id"), F.lit(4))).cache()
    written = []
    for n, part in enumerate([0, 1, 2, 3, 1]):
        reduced = table.reduce(events.where(F.col("part") == part))
        state.update_states(reduced, root, n, "r", table.keys, table.combine, buckets=8, compact_every=3)
        seen = log.snapshot(spark, root)
        folder = list(seen.batches.values())[-1]["state"]
        written.append(spark.read.parquet(f"{root}/{folder}").count() if seen.deltas("state") else None)
    got = table.finish(state.read_states(spark, root, table.keys, table.combine))
    assert rows_of(got) == rows_of(table.build(events))
    assert written[-1] == 0 or written[-1] is None
    events.unpersist()


def test_device_stream_equals_batch(spark, lines, tmp_path):
    """Distinct devices of a stream of several files, without a state store and with a restart."""
    source, root = tmp_path / "in", str(tmp_path / "d")
    texts = [r.json_str for r in lines.limit(600).collect()]
    source.mkdir()

    def run():
        stream = build_dim_device(stream_json_lines(spark, str(source), files_per_trigger=1), distinct=False)
        write = state.first_writer(root, stream.columns, buckets=4, compact_every=3)
        sinks.start_stream(stream, write, f"{root}/_checkpoint", every=None).awaitTermination()

    for n in range(4):
        (source / f"{n}.txt").write_text("\n".join(texts[150 * n:150 * n + 150]))
        if n != 1:
            run()
    assert rows_of(state.read_first(spark, root)) == rows_of(build_dim_device(read_json_lines(spark, str(source))))
    assert json.loads(log.read_text(spark, f"{root}/_log/run-000001.json"))["run"]
