"""Command line for spark-submit: load the stream, extract pages, merge products, build facts.

    spark-submit ... -m vitrine.app stream --bootstrap host:9092 --root <warehouse>
    spark-submit ... -m vitrine.app extract --pages <parquet> --root <warehouse>
    spark-submit ... -m vitrine.app merge --root <warehouse>

Passwords are read from the environment variable that `--password-env` names.
"""

from __future__ import annotations

import argparse
import datetime
import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from vitrine.operators import crawl
from vitrine.operators.facts import build_fact_event, write_fact
from vitrine.operators.mergeable import TABLES
from vitrine.operators.merge import append_missing, merge_product_final
from vitrine.operators.pages import extract_product_info
from vitrine.operators.parse import decode_value
from vitrine.schemas import PRODUCT_INFO
from vitrine.session import get_session
from vitrine.sources.files import read_json_lines
from vitrine.sources.kafka import read_kafka_stream
from vitrine.streaming.jobs import compact_table, read_table, start_warehouse_stream
from vitrine.streaming.sinks import wait_for_all
from vitrine.streaming.upsert import compact as fold, read_current, write_tables


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table that may not have been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Kafka topic to all dimension tables, until stopped."""
    records = read_kafka_stream(
        spark, bootstrap=args.bootstrap, topic=args.topic, security_protocol=args.security_protocol,
        sasl_mechanism=args.sasl_mechanism, username=args.username,
        password=os.environ.get(args.password_env), starting_offsets=args.starting_offsets)
    wait_for_all([start_warehouse_stream(decode_value(records), args.root, f"{args.root}/_checkpoint",
                                         every=args.every)])


def fact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Event text files to the fact table."""
    write_fact(build_fact_event(read_json_lines(spark, args.lines)), f"{args.root}/fact_event",
               mode="overwrite" if args.replace_dates else "append")


def crawl_state(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Where the crawl stands, None before its first round."""
    try:
        return crawl.crawl_states(read_current(spark, f"{args.root}/crawl", crawl.combine_results, "states"),
                                  attempts=args.attempts)
    except FileNotFoundError:
        return None


def worklist(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pages to fetch now, as a table for the fetcher: new ones and failed ones that are due again."""
    todo = crawl.due_pages(read_table(spark, args.root, "dim_prd"), crawl_state(spark, args))
    todo.write.mode("overwrite").parquet(f"{args.root}/crawl_worklist")


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """A round of fetched pages to product_info and the crawl's states, both at once.  A round counts once,
    however often it is run; pages that succeeded in an earlier round are left out."""
    pages, known = spark.read.parquet(args.pages), crawl_state(spark, args)
    if known is not None:
        done = known.where(known["succeeded_at"].isNotNull()).select(known["current_url"].alias("url"))
        pages = pages.join(done, "url", "left_anti")
    info = extract_product_info(pages, suffixes=args.suffix)
    name = args.round or args.pages
    states = crawl.reduce_results(info, name, F.lit(datetime.datetime.now(datetime.timezone.utc)))
    write_tables({"product_info": info.select([f.name for f in PRODUCT_INFO.fields]), "states": states},
                 f"{args.root}/crawl", 0, name)


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """New products with page details to dim_product_final.  Pages that failed wait for their next attempt."""
    path = f"{args.root}/dim_product_final"
    info = read_current(spark, f"{args.root}/crawl", lambda rows: rows, "product_info").where("error IS NULL")
    rows = merge_product_final(
        read_table(spark, args.root, "dim_product"), read_table(spark, args.root, "dim_prd"),
        info, stored(spark, path), args.mode)
    append_missing(rows, path)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold the deltas of every dimension and of the crawl into new bases."""
    for name in TABLES:
        compact_table(spark, args.root, name)
    fold(spark, f"{args.root}/crawl", crawl.combine_results, "states")
    fold(spark, f"{args.root}/crawl", None, "product_info")


COMMANDS = {"stream": stream, "fact": fact, "worklist": worklist, "extract": extract, "merge": merge,
            "compact": compact}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="vitrine")
    commands = out.add_subparsers(dest="command", required=True)
    parsers = {name: commands.add_parser(name, help=run.__doc__) for name, run in COMMANDS.items()}
    for sub in parsers.values():
        sub.add_argument("--root", required=True, help="warehouse folder on shared storage")
    s = parsers["stream"]
    s.add_argument("--bootstrap", required=True)
    s.add_argument("--topic", default="product_view")
    s.add_argument("--security-protocol")
    s.add_argument("--sasl-mechanism")
    s.add_argument("--username")
    s.add_argument("--password-env", default="KAFKA_PASSWORD")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--every", default="10 seconds")
    parsers["fact"].add_argument("--lines", required=True, help="text files, one event per line")
    parsers["fact"].add_argument("--replace-dates", action="store_true",
                                 help="replace the dates that occur in the files instead of appending")
    for name in ("worklist", "extract"):
        parsers[name].add_argument("--attempts", type=int, default=crawl.ATTEMPTS, help="after which a page is given up")
    parsers["extract"].add_argument("--round", help="name of the round of fetches, by default the path of its pages")
    parsers["extract"].add_argument("--pages", required=True, help="parquet table with url and html")
    parsers["extract"].add_argument("--suffix", action="append", default=[], help="title suffix to strip, in order")
    parsers["merge"].add_argument("--mode", choices=["all", "latest"], default="all")
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(f"vitrine-{args.command}")
    COMMANDS[args.command](spark, args)


if __name__ == "__main__":
    main()
