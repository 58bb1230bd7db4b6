"""Kafka source.  Needs the spark-sql-kafka package on the cluster; only the options are tested."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SECRET_OPTIONS = ("kafka.sasl.jaas.config",)


def kafka_options(bootstrap: str, topic: str, security_protocol: str | None = None,
                  sasl_mechanism: str | None = None, username: str | None = None,
                  password: str | None = None, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = False,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options; with a user name, SASL PLAIN credentials are added."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if security_protocol:
        options["kafka.security.protocol"] = security_protocol
    if sasl_mechanism:
        options["kafka.sasl.mechanism"] = sasl_mechanism
    if username is not None:
        def quoted(text: str) -> str:
            return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

        options["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f"username={quoted(username)} password={quoted(password or '')};")
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def redacted(options: dict[str, str]) -> dict[str, str]:
    """The options as they may be printed."""
    return {k: "***" if k in SECRET_OPTIONS else v for k, v in options.items()}


def read_kafka_stream(spark: SparkSession, **settings) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(**settings)).load()


def read_kafka_batch(spark: SparkSession, **settings) -> DataFrame:
    settings.setdefault("starting_offsets", "earliest")
    return spark.read.format("kafka").options(**kafka_options(**settings)).load()
