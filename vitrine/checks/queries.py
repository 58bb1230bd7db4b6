"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.checks import fixtures as fx
from vitrine.functions.keys import shown
from vitrine.functions.money import price_amount
from vitrine.operators import crawl, currency, customers, dates, delta_join, device_sketches, devices, facts, history
from vitrine.operators import history_store, merge, option_dims, pages, products, quality, rollups, timeline
from vitrine.operators.frequent import heavy_from_summaries
from vitrine.operators.mergeable import TABLES, needed_fields
from vitrine.operators.parse import parse_events
from vitrine.plans import engagement, geography, technology, traffic
from vitrine.plans import products as product_plans
from vitrine.schemas import EVENT_FIELDS
from vitrine.session import work_dir
from vitrine.sources.currency_list import currency_list
from vitrine.sources.files import product_urls
from vitrine.streaming import jobs, log, sinks, state, upsert

# Suffixes of the shop in the page fixtures, tried in this order.
SHOP_SUFFIXES = [" | SHOP.de", " - SHOP.de", " | SHOP", " - SHOP"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_stored: dict[tuple[str, str], str] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The session belongs to the caller; day boundaries must not depend on its zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.click_lines(spark, sf_dir)


def load_fact(spark: SparkSession, sf_dir: str) -> str:
    """Parse the click texts once and store the fact table; analytics read its columns."""
    path = work_dir(spark, "fact_event")
    facts.write_fact(facts.build_fact_event(lines(spark, sf_dir)), path)
    return path


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact table."""
    return spark.read.parquet(loaded(spark, sf_dir, load_fact))


def load_timeline(spark: SparkSession, sf_dir: str) -> str:
    """Store the next events of devices beside the fact table."""
    root = work_dir(spark, "timeline")
    timeline.refresh_timeline(fact(spark, sf_dir), root)
    return root


def loaded(spark: SparkSession, sf_dir: str, load) -> str:
    """Where `load` has stored something, done once per session and data set."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} {load.__name__}")
    if key not in _stored:
        _stored[key] = load(spark, sf_dir)
    return _stored[key]


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All views with their duration, from the stored timeline."""
    return timeline.timeline_views(timeline.read_timeline(spark, loaded(spark, sf_dir, load_timeline)))


def heavy_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices with much of all events, from the summaries stored beside the timeline."""
    return heavy_from_summaries(timeline.read_key_summary(spark, loaded(spark, sf_dir, load_timeline)), "device_id")


def load_sketches(spark: SparkSession, sf_dir: str) -> str:
    """Store the device sketches of every date, country and store."""
    path = work_dir(spark, "sketches")
    device_sketches.write_device_sketches(fact(spark, sf_dir), path)
    return path


def load_rollups(spark: SparkSession, sf_dir: str) -> str:
    """Store the lattice of counts, loaded in two parts."""
    root = work_dir(spark, "rollups")
    for n in (0, 1):
        rollups.add_counts(fact(spark, sf_dir).where(F.col("date_id") % 2 == n), root, n, "load")
    return root


# Dimensions that facts refer to by surrogate key, and the natural keys these stand for.
KEYED = {"product_key": ("dim_product", ["product_id", "collection"]), "device_key": ("dim_device", ["device_id", "user_agent"]),
         "customer_key": ("dim_customer", ["user_id", "email_address"]), "store_key": ("dim_store", ["store_id", "country_code"])}


def load_dims(spark: SparkSession, sf_dir: str) -> str:
    """Build the keyed dimensions and the calendar from the click texts, apart from the facts, and store them."""
    root, names = work_dir(spark, "dims"), ["dim_product", "dim_device", "dim_customer"]
    events = parse_events(lines(spark, sf_dir), sorted({*needed_fields([*names, "dim_date"]), "store_id", "current_url"})).persist()
    dims = {name: TABLES[name].keyed(TABLES[name].reduce(events)) for name in names}
    dims["dim_date"] = TABLES["dim_date"].build(events)
    dims["dim_store"] = facts.dim_store(facts.fact_event(events, ["store_id", "country_code"]), keyed=True)
    upsert.write_tables(dims, root, 0, "load")
    events.unpersist()
    return root


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stored dimensions by name."""
    root = loaded(spark, sf_dir, load_dims)
    seen = log.snapshot(spark, root)
    return {name: upsert.read_current(spark, root, lambda rows: rows, name, seen) for name in seen.tables()}


def info(spark: SparkSession, sf_dir: str, structured: bool = False) -> DataFrame:
    return pages.extract_product_info(fx.product_pages(spark, sf_dir), suffixes=SHOP_SUFFIXES, structured=structured)


def millis(name: str) -> F.Column:
    return F.unix_millis(name).alias(name)


# --- ingestion and dimensions -------------------------------------------------------------

@query
def parsed_events(spark, sf_dir):
    events = parse_events(lines(spark, sf_dir))
    texts = [c for c in EVENT_FIELDS if c not in ("time_stamp", "option")]
    return events.select(*texts, F.unix_millis("time_stamp").alias("event_ms"),
                         F.to_json("option").alias("option_json"))


@query
def dim_prd(spark, sf_dir):
    return products.build_dim_prd(lines(spark, sf_dir))


@query
def dim_prd_events(spark, sf_dir):
    return products.build_dim_prd(lines(spark, sf_dir), distinct=False)


@query
def dim_date(spark, sf_dir):
    return dates.build_dim_date(lines(spark, sf_dir), F.lit("2024-01-01").cast("date"))


@query
def dim_device(spark, sf_dir):
    return devices.build_dim_device(lines(spark, sf_dir))


@query
def dim_device_events(spark, sf_dir):
    return devices.build_dim_device(lines(spark, sf_dir), distinct=False)


@query
def dim_device_precise(spark, sf_dir):
    return devices.build_dim_device(lines(spark, sf_dir), rules="precise")


@query
def dim_customer(spark, sf_dir):
    return customers.build_dim_customer(lines(spark, sf_dir))


@query
def dim_diamond_option(spark, sf_dir):
    return option_dims.build_dim_diamond_option(lines(spark, sf_dir))


@query
def dim_alloy_option(spark, sf_dir):
    return option_dims.build_dim_alloy_option(lines(spark, sf_dir))


@query
def dim_alloy_option_values(spark, sf_dir):
    return option_dims.build_dim_alloy_option(lines(spark, sf_dir), key="value")


@query
def dim_product(spark, sf_dir):
    return products.build_dim_product(lines(spark, sf_dir))


@query
def dim_product_optionless(spark, sf_dir):
    return products.build_dim_product(lines(spark, sf_dir), keep_optionless=True)


@query
def dim_currency(spark, sf_dir):
    return currency.build_dim_currency(lines(spark, sf_dir), spark)


@query
def dim_currency_best(spark, sf_dir):
    return currency.build_dim_currency(lines(spark, sf_dir), spark, mode="best", distinct=True)


@query
def fact_event(spark, sf_dir):
    columns = ["event_id", "date_id", "collection", "product_id", "device_id", "store_id",
               "country_code", "campaign", "referrer_host", "has_option", "diamond_option_id",
               "alloy_option_id", "raw_currency", "customer"]
    rows = facts.build_fact_event(lines(spark, sf_dir), [*columns, *KEYED])
    return rows.select(*columns, *[shown(F.col(key)).alias(key) for key in KEYED])


@query
def star_join(spark, sf_dir):
    """Events per calendar month, browser and product options, through surrogate keys."""
    known = dims(spark, sf_dir)
    return facts.star_counts(
        fact(spark, sf_dir),
        {"date_id": known["dim_date"].select("date_id", "month_name"),
         "device_key": known["dim_device"].select("device_key", "browser"),
         "product_key": known["dim_product"].select("product_key", "diamond_option_id", "alloy_option_id")},
        ["month_name", "browser", "diamond_option_id", "alloy_option_id"])


@query
def dim_store(spark, sf_dir):
    return facts.build_dim_store(lines(spark, sf_dir))


@query
def dim_product_scd2(spark, sf_dir):
    spans = history.product_history(fx.product_versions(spark, sf_dir))
    return spans.select("product_id", "product_name", "category", "raw_price", "price", "quality",
                        "quality_label", millis("record_created_date"),
                        millis("record_expired_date"), "is_current_record")


@query
def dim_product_scd2_batches(spark, sf_dir):
    """The same history from two batches of versions that arrive out of order."""
    root, versions = work_dir(spark, "history"), fx.product_versions(spark, sf_dir)
    for n in range(2):
        history_store.update_history(versions.where(F.pmod(F.hash("product_id", "seen_at"), F.lit(2)) == n), root, n, "load", buckets=8)
    return history_store.read_history(spark, root).select(
        "product_id", "product_name", "category", "raw_price", "price", "quality", "quality_label",
        millis("record_created_date"), millis("record_expired_date"), "is_current_record")


# --- pages and merge ----------------------------------------------------------------------

@query
def product_info(spark, sf_dir):
    return info(spark, sf_dir)


@query
def product_info_given_pages(spark, sf_dir):
    return pages.extract_product_info(fx.spread(fx.table(spark, sf_dir, "pages")))


@query
def crawl_outcome(spark, sf_dir):
    """Fetches of four rounds, some of which failed."""
    return pages.crawl_outcome(pages.extract_product_info(fx.crawl_rounds(spark, sf_dir)))


def round_states(spark, sf_dir) -> DataFrame:
    """States of all pages after four rounds, each stored as a part of its own; the last one twice."""
    root = work_dir(spark, "crawl")
    fetched = fx.crawl_rounds(spark, sf_dir)
    for n in [0, 1, 2, 3, 3]:
        of = fetched.where(F.col("round") == n)
        results = pages.extract_product_info(of).withColumn("fetched_at", fx.round_time(F.lit(n)))
        upsert.write_delta(crawl.reduce_results(results, f"round {n}"), root, n, "rounds")
    return crawl.crawl_states(upsert.read_current(spark, root, crawl.combine_results), attempts=4)


@query
def crawl_states(spark, sf_dir):
    """Attempts, last failure and next attempt of every page."""
    return round_states(spark, sf_dir).select(
        "current_url", "attempts", "last_error", millis("succeeded_at"), millis("last_failed_at"), millis("due_at"))


@query
def crawl_outcomes(spark, sf_dir):
    return crawl.outcome_counts(round_states(spark, sf_dir))


@query
def crawl_due(spark, sf_dir):
    """Pages to fetch six hours after the last round: never tried ones, and failed ones whose pause is over."""
    return crawl.due_pages(products.build_dim_prd(lines(spark, sf_dir)), round_states(spark, sf_dir),
                           fx.round_time(F.lit(4)))


@query
def product_page_urls(spark, sf_dir):
    return product_urls(products.build_dim_prd(lines(spark, sf_dir), distinct=False))


@query
def crawl_worklist(spark, sf_dir):
    known = fx.product_pages(spark, sf_dir).select(F.col("url").alias("current_url"))
    return products.crawl_worklist(products.build_dim_prd(lines(spark, sf_dir)), known)


@query
def product_final(spark, sf_dir):
    raw = lines(spark, sf_dir)
    return merge.merge_product_final(products.build_dim_product(raw), products.build_dim_prd(raw),
                                     info(spark, sf_dir))


@query
def product_final_rounds(spark, sf_dir):
    """The same merge in two rounds, each bringing some products, pages and details."""
    root, fetched = work_dir(spark, "merge"), fx.product_pages(spark, sf_dir)
    known = dims(spark, sf_dir)["dim_product"].drop("product_key")
    seen = fact(spark, sf_dir).select("product_id", "current_url").distinct()
    for n in range(2):
        new, pairs, read = (rows.where(F.pmod(F.hash(key), F.lit(2)) == n)
                            for rows, key in ((known, "collection"), (seen, "product_id"), (fetched, "url")))
        details = pages.extract_product_info(read, suffixes=SHOP_SUFFIXES)
        delta_join.merge_round(new, pairs, details, root, n, "rounds", buckets=8)
    return delta_join.read_merged(spark, root)


@query
def product_final_latest(spark, sf_dir):
    """One row per product; the products that an even supplier key names count as merged already."""
    raw = lines(spark, sf_dir)
    existing = fx.table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").cast("string").alias("product_id"))
    return merge.merge_product_final(
        products.build_dim_product(raw), products.build_dim_prd(raw, last_seen=True),
        info(spark, sf_dir), existing, mode="latest")


@query
def price_decimal(spark, sf_dir):
    return info(spark, sf_dir, structured=True).select(
        "current_url", "price", price_amount(F.col("price"), structured=F.col("price_structured")).alias("amount"))


@query
def amount_usd(spark, sf_dir):
    return currency.prices_in_usd(info(spark, sf_dir, structured=True), currency_list(spark))


# --- analytics ----------------------------------------------------------------------------

@query
def top_products(spark, sf_dir):
    return product_plans.top_products(fact(spark, sf_dir))


@query
def daily_views(spark, sf_dir):
    return product_plans.daily_views(fact(spark, sf_dir))


@query
def product_funnel(spark, sf_dir):
    return product_plans.product_funnel(fact(spark, sf_dir))


@query
def option_pairs(spark, sf_dir):
    return product_plans.option_pairs(fact(spark, sf_dir))


@query
def top_countries(spark, sf_dir):
    return geography.top_countries(fact(spark, sf_dir))


@query
def cross_border(spark, sf_dir):
    return geography.cross_border(fact(spark, sf_dir))


@query
def penetration(spark, sf_dir):
    return geography.penetration(fact(spark, sf_dir))


@query
def penetration_approx(spark, sf_dir):
    """Exact device counts, and whether the sketch's are within 5 %."""
    exact = geography.penetration(fact(spark, sf_dir)).select("country_code", "devices")
    near = geography.penetration(fact(spark, sf_dir), approximate=True).select(
        "country_code", F.col("devices").alias("about"))
    apart = F.abs(F.col("about") - F.col("devices"))
    return exact.join(near, "country_code").select(
        "country_code", "devices", (apart <= F.greatest(F.lit(1.0), 0.05 * F.col("devices"))).alias("within"))


def sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(loaded(spark, sf_dir, load_sketches))


@query
def penetration_sketch(spark, sf_dir):
    """Devices per country from stored sketches; exact for as many devices as these tables have."""
    return device_sketches.device_penetration(sketches(spark, sf_dir))


@query
def country_overlap(spark, sf_dir):
    """Devices seen in both countries of a pair, from stored sketches."""
    return device_sketches.country_overlap(sketches(spark, sf_dir))


@query
def store_devices_period(spark, sf_dir):
    """Devices per store over ten days, from stored sketches."""
    some = sketches(spark, sf_dir).where(F.col("date_id").between(20240105, 20240114) & F.col("store_id").isNotNull())
    return device_sketches.device_counts(some, ["country_code", "store_id"])


@query
def store_compare(spark, sf_dir):
    return geography.store_comparison(fact(spark, sf_dir))


@query
def store_rank(spark, sf_dir):
    return geography.store_rank(fact(spark, sf_dir))


@query
def regional_cube(spark, sf_dir):
    return geography.regional_cube(fact(spark, sf_dir))


@query
def regional_cube_stored(spark, sf_dir):
    """The same cube from stored counts."""
    return rollups.cube_counts(spark, loaded(spark, sf_dir, load_rollups), ["country_code", "store_id", "collection"])


@query
def top_referrers(spark, sf_dir):
    return traffic.top_referrers(fact(spark, sf_dir))


@query
def top_referrer_hosts(spark, sf_dir):
    return traffic.top_referrers(fact(spark, sf_dir), by="referrer_host")


@query
def attribution(spark, sf_dir):
    return traffic.attribution(fact(spark, sf_dir), heavy_devices(spark, sf_dir))


@query
def campaign(spark, sf_dir):
    return traffic.campaign_effect(fact(spark, sf_dir))


@query
def view_duration(spark, sf_dir):
    return engagement.duration_by_product_country(views(spark, sf_dir))


@query
def view_duration_customising(spark, sf_dir):
    return engagement.duration_by_customising(views(spark, sf_dir))


@query
def view_duration_option(spark, sf_dir):
    return engagement.duration_by_option(views(spark, sf_dir))


@query
def country_preference(spark, sf_dir):
    return engagement.country_preference(fact(spark, sf_dir))


@query
def tech_stats(spark, sf_dir):
    return technology.tech_stats(fact(spark, sf_dir))


@query
def segments(spark, sf_dir):
    return technology.customer_segments(fact(spark, sf_dir))


# --- data quality -------------------------------------------------------------------------

@query
def dq_quarantine(spark, sf_dir):
    _, bad = quality.split_events(fx.dirty_lines(spark, sf_dir))
    return bad.drop("json_str")


@query
def dq_good(spark, sf_dir):
    good, _ = quality.split_events(fx.dirty_lines(spark, sf_dir), ["_id", "collection", "option"])
    return good.select("_id", "collection")


@query
def dq_profile(spark, sf_dir):
    events = parse_events(lines(spark, sf_dir), ["_id", "user_id_db", "referrer_url",
                                                 "email_address", "collection", "currency"])
    return quality.profile(events, {"email_address": F.col("email_address").contains("@"),
                                    "currency": F.col("currency").rlike("^[A-Z]{3}$")})


@query
def dq_refcheck(spark, sf_dir):
    """Facts without a row in the dimension they refer to; dimensions are built apart from the facts."""
    known, page_urls = dims(spark, sf_dir), fx.product_pages(spark, sf_dir).select("url")
    return quality.reference_gaps(fact(spark, sf_dir), {
        "page": (page_urls, "current_url", "url"), "date": (known["dim_date"], "date_id", "date_id"),
        **{table.removeprefix("dim_"): (known[table], key, key) for key, (table, _) in KEYED.items()}})


@query
def dq_key_audit(spark, sf_dir):
    """Natural keys that share a surrogate key."""
    events = parse_events(lines(spark, sf_dir), ["product_id", "collection", "device_id", "user_agent", "user_id_db",
                                                 "email_address", "store_id", "current_url"])
    user, mail = customers.customer_key_columns()
    natural = events.withColumns({"user_id": user, "email_address": mail}).withColumn(
        "country_code", facts.fact_columns()["country_code"][1])
    return quality.key_audit({table: (facts.with_key(natural.select(*names), key, names), key, names)
                              for key, (table, names) in KEYED.items()})


@query
def dq_audit(spark, sf_dir):
    events = parse_events(lines(spark, sf_dir), ["time_stamp"])
    return quality.audit_rows(events, "events", 0).select(
        "table_name", "batch_id", "rows", millis("max_event_time"))


# --- streaming ----------------------------------------------------------------------------

def finish(stream: DataFrame, root: str, mode: str = "append") -> None:
    """Work off everything available into the deltas of one table."""
    finish_parts(stream, root, lambda batch: batch, mode)


def finish_parts(stream: DataFrame, root: str, reduce, mode: str = "append") -> None:
    """The same, with each micro-batch reduced before it is stored."""
    sinks.start_stream(stream, lambda batch, n: upsert.write_delta(reduce(batch), root, n, upsert.run_of(batch)),
                       f"{root}/_checkpoint", mode, every=None, skip_empty=True).awaitTermination()


@query
def stream_dim_product(spark, sf_dir):
    """The update-mode aggregation over four batches: each writes the keys it changes into the
    bucketed state, which is the table."""
    root, table = work_dir(spark, "stream_dim_product"), TABLES["dim_product"]
    events = parse_events(fx.click_stream(spark, sf_dir, batches=4), table.fields)
    sinks.start_stream(events, state.state_writer(root, table.keys, table.combine, table.reduce, buckets=8),
                       f"{root}/_checkpoint", every=None).awaitTermination()
    return table.finish(state.read_states(spark, root, table.keys, table.combine))


@query
def stream_dims(spark, sf_dir):
    """All dimensions from one query over the source; their rows as (table, text)."""
    root = work_dir(spark, "stream_dims")
    jobs.start_warehouse_stream(fx.click_stream(spark, sf_dir), root, f"{root}/_checkpoint",
                                every=None).awaitTermination()
    out, seen = None, log.snapshot(spark, root)
    for name in TABLES:
        dim = jobs.read_table(spark, root, name, seen)
        if name == "dim_prd":
            dim = dim.withColumn("last_seen", F.unix_millis("last_seen"))
        if name == "dim_currency":
            dim = dim.drop("usd_exchange_rate")
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in dim.columns])
        rows = dim.select(F.lit(name).alias("table_name"), text.alias("row_text"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def stream_device_dedup(spark, sf_dir):
    """Append-mode duplicate removal over four batches, against the bucketed table of seen rows."""
    root = work_dir(spark, "stream_device")
    rows = devices.build_dim_device(fx.click_stream(spark, sf_dir, batches=4), distinct=False)
    sinks.start_stream(rows, state.first_writer(root, rows.columns, buckets=8), f"{root}/_checkpoint",
                       every=None).awaitTermination()
    return state.read_first(spark, root)


@query
def stream_first_events(spark, sf_dir):
    """The first event of each device and hour, whose keys expire with the watermark."""
    root = work_dir(spark, "stream_first")
    events = _events_stream(spark, sf_dir, ["_id", "time_stamp", "device_id"]).withColumn(
        "hour", F.date_trunc("hour", "time_stamp"))
    sinks.start_stream(events, state.first_writer(root, ["device_id", "hour"], "time_stamp", delay="40 days", buckets=8),
                       f"{root}/_checkpoint", every=None).awaitTermination()
    return state.read_first(spark, root).select("device_id", millis("hour"), millis("time_stamp"), "_id")


@query
def stream_currency(spark, sf_dir):
    """Stream joined to the static currency list."""
    root = work_dir(spark, "stream_currency")
    finish(currency.build_dim_currency(fx.click_stream(spark, sf_dir), spark), root)
    return upsert.read_current(spark, root, lambda stored: stored.drop("batch"))


def _events_stream(spark: SparkSession, sf_dir: str, fields: list[str]) -> DataFrame:
    return parse_events(fx.click_stream(spark, sf_dir), fields)


def _windows(spark, sf_dir, label, size, slide=None):
    root = work_dir(spark, label)
    events = _events_stream(spark, sf_dir, ["time_stamp", "collection", "store_id"])
    finish_parts(events, root, lambda batch: jobs.view_parts(batch, size, slide, ["store_id"]))
    whole = upsert.read_current(spark, root, lambda stored: jobs.whole_windows(stored, ["store_id"]))
    return whole.select(millis("window_start"), millis("window_end"), "store_id", "views", "closed")


@query
def stream_views_tumbling(spark, sf_dir):
    """All windows, the open ones as well; parts of the micro-batches are added when read."""
    return _windows(spark, sf_dir, "stream_tumbling", "1 hour")


@query
def stream_views_sliding(spark, sf_dir):
    return _windows(spark, sf_dir, "stream_sliding", "2 hours", "1 hour")


@query
def stream_views_session(spark, sf_dir):
    root = work_dir(spark, "stream_sessions")
    finish_parts(_events_stream(spark, sf_dir, ["time_stamp", "device_id"]), root, jobs.session_parts)
    whole = upsert.read_current(spark, root, jobs.whole_sessions)
    return whole.select("device_id", millis("session_start"), millis("session_end"), "events", "closed")
