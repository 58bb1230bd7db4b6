"""JDBC table source and sink.  Needs the database's driver on the cluster; only the options are
tested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = 10_000,
                 partitions: int | None = None) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if partitions:
        # Upper bound on concurrent connections.
        options["numPartitions"] = str(partitions)
    return options


def append_jdbc(df: DataFrame, **settings) -> None:
    df.write.format("jdbc").options(**jdbc_options(**settings)).mode("append").save()


def read_jdbc(spark: SparkSession, partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, **settings) -> DataFrame:
    """Read a table; with a numeric partition column the read is split into `partitions` ranges."""
    options = jdbc_options(**settings)
    if partition_column:
        options.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper))
    return spark.read.format("jdbc").options(**options).load()
