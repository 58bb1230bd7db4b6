"""Event text files and warehouse tables on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions.text import filled
from vitrine.schemas import PRODUCT_INFO


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One event text per line, unparsed."""
    return spark.read.text(path).withColumnRenamed("value", "json_str")


def stream_json_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).withColumnRenamed("value", "json_str")


def to_json_lines(events: DataFrame) -> DataFrame:
    """Events back to JSON text."""
    return events.select(F.to_json(F.struct(*events.columns)).alias("json_str"))


def product_urls(dim_prd: DataFrame) -> DataFrame:
    """Distinct pages of the product table that can be fetched, ordered by product."""
    return (dim_prd.where(filled(F.col("current_url"))).select("product_id", "current_url")
            .distinct().orderBy("product_id", "current_url"))


def append_product_info(extracted: DataFrame, path: str) -> None:
    """Append extracted pages in one set-based write; `error` tells pages that could not be read."""
    extracted.select([f.name for f in PRODUCT_INFO.fields]).write.mode("append").parquet(path)
