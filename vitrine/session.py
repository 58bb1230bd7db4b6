"""Session and shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that do not depend on the cluster size.  The number of shuffle partitions is left to
# AQE: it starts from `initialPartitionNum` and merges small ones down to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Sessions of a busy device are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app_name: str = "vitrine", master: str | None = None,
                shuffle_partitions: int | None = None, conf: dict[str, str] | None = None,
                log_level: str = "ERROR") -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        settings = dict(DEFAULTS)
        if shuffle_partitions:
            settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        settings.update(conf or {})
        for name, value in settings.items():
            builder = builder.config(name, value)
        spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder on storage every executor can reach.

    The cluster names it in `spark.checkpoint.dir`.  Only a local master may fall back to a
    temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="vitrine-")
    return f"{root.rstrip('/')}/vitrine/{label}-{uuid.uuid4().hex}"
