"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median is reported (default 1)
BENCH_ONLY    comma-separated query names (default all)

Every query is run to the end into Spark's `noop` sink.  `load_fact` parses the click texts and
stores the fact table the analytics read, the other loads what is kept beside it; their time is part of
the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitrine.checks import queries as q  # noqa: E402
from vitrine.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = get_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                        conf={"spark.ui.enabled": "false", "spark.driver.memory": "8g",
                              "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    def drain(name: str):
        return lambda: q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    names = ("load_fact", "load_timeline", "load_dims", "load_sketches", "load_rollups")
    loads = {n: (lambda load=getattr(q, n): load(spark, sf_dir)) for n in names}
    jobs = {**loads, **{n: drain(n) for n in q.QUERIES}}
    seconds = {}
    for name, job in jobs.items():
        if only and name not in only:
            continue
        job()
        seconds[name] = round(statistics.median(timed(job) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    name = os.path.basename(sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(name[2:]) if name.startswith("sf") else name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
