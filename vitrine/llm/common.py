"""Helpers shared by the operators: stored tables, row keys, words, connected components."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.session import work_dir

# One word: a run of characters outside blank and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(1 << 63)
ROWS_AT_ONCE = 512
# Vocabulary files of public tokenizers lie outside the repository.
TOKENIZERS = os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage without executor-local copies."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_id(name: str = "doc_id") -> Column:
    """The id as a join key; a missing id counts as one value of its own."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(name: str, n: int) -> Column:
    """crc32 of the id's text modulo `n`; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(n))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def pieces(total: float, each: float, least: int = 1) -> int:
    return max(least, math.ceil(total / each))


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) of every node of `edges(a, b)`; the component is its smallest node.

    Contraction: every node points to the smallest of itself and its neighbours, pointers are
    followed once more, and edges between what they point to go on.  Every node that still has an
    edge merges with another one, so the nodes at least halve and the rounds are logarithmic.
    Each round is stored; only a count reaches the driver.
    """
    links = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), label)
    result = stored(links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                    .select("node", F.col("node").alias("component")), label)
    while not links.isEmpty():
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        first = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        first = stored(first, label)
        second = first.select(F.col("u").alias("p"), F.col("p").alias("q"))
        point = stored(first.join(second, "p", "left").select("u", F.coalesce("q", "p").alias("p")), label)
        result = stored(
            result.join(point.select(F.col("u").alias("component"), "p"), "component", "left")
            .select("node", F.coalesce("p", "component").alias("component")), label)
        left = point.select(F.col("u").alias("a"), F.col("p").alias("x"))
        right = point.select(F.col("u").alias("b"), F.col("p").alias("y"))
        links = stored(
            links.join(left, "a").join(right, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), label)
    return result


def map_texts(df: DataFrame, column: str, added: str, run: Callable[[list], list[list]]) -> DataFrame:
    """Replace `column` by the columns of the schema text `added`, which `run` makes from the list of
    some hundred values.  The other columns pass through as they are, nulls and wide integers included."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    new = _parse_datatype_string(added)
    names = [c for c in df.columns if c != column]
    schema = StructType(list(df.select(*names).schema.fields) + list(new.fields))
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
             "array<bigint>": pa.list_(pa.int64())}
    kinds = [(f.name, arrow[f.dataType.simpleString()]) for f in new.fields]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A batch has up to 10,000 rows; as Python lists their values would take many times their size.
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, max(1, len(b)), ROWS_AT_ONCE)):
            made = run(batch.column(column).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(v, t) for v, (_, t) in zip(made, kinds)],
                names=names + [n for n, _ in kinds])

    return df.select(*names, column).mapInArrow(each, schema)
