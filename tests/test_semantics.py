"""One test per rule of event parsing and dimension building, on literal rows."""

import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import json_df, rows_of
from vitrine.operators.currency import build_dim_currency, currency_keys, match_currency
from vitrine.operators.customers import build_dim_customer
from vitrine.operators.dates import build_dim_date
from vitrine.operators.devices import build_dim_device
from vitrine.operators.merge import merge_product_final
from vitrine.operators.option_dims import build_option_dim
from vitrine.operators.parse import parse_events
from vitrine.operators.products import build_dim_prd, build_dim_product, crawl_worklist
from vitrine.operators.quality import checked_events
from vitrine.sources.currency_list import ROWS, currency_list


def event(**fields):
    return json.dumps(fields)


def option(label, oid, vlabel=None, vid=None):
    return {"option_label": label, "option_id": oid, "value_label": vlabel, "value_id": vid}


def test_malformed_text_becomes_a_row_of_nulls(spark):
    df = parse_events(json_df(spark, "{bad", "", None, '[{"_id":"a"},{"_id":"b"}]', '{"_id":"ok"}'), ["_id", "ip"])
    assert rows_of(df) == rows_of(spark.createDataFrame([(None, None)] * 4 + [("ok", None)], df.schema))


def test_wrongly_typed_option_nulls_only_that_field(spark):
    df = parse_events(json_df(spark, '{"_id":"1","option":""}', '{"_id":"2","option":{}}'), ["_id", "option"])
    assert rows_of(df) == [("1", None), ("2", None)]


@pytest.mark.parametrize("raw, expected", [
    ("1591266092000", "2020-06-04 10:21:32"), (1591266092000, "2020-06-04 10:21:32"),
    (1591266092, "2020-06-04 10:21:32"), ("1591266092", "2020-06-04 10:21:32"),
    (1591266092.5, "2020-06-04 10:21:32.5"),
    ("2020-06-04T10:21:32Z", "2020-06-04 10:21:32"), ("2020-06-04 10:21:32", "2020-06-04 10:21:32"),
    ("2020-06-04T12:21:32.250+02:00", "2020-06-04 10:21:32.25"),
    ("soon", None), ("", None), (None, None), ("99999999999999999", None),
])
def test_event_times(spark, raw, expected):
    df = parse_events(json_df(spark, event(time_stamp=raw, ip="kept")), ["time_stamp", "ip"])
    row = df.select(F.col("time_stamp").cast("string").alias("t"), "ip").first()
    assert (row.t, row.ip) == (expected, "kept")


def test_reference_time_mode_reads_numbers_as_seconds(spark):
    df = build_dim_date(json_df(spark, event(time_stamp=1591266092000)), "drop", time_mode="reference")
    assert df.select("date_id").first().date_id == 523950320
    df = parse_events(json_df(spark, event(time_stamp="1591266092")), ["time_stamp"], "reference")
    assert df.first().time_stamp is None


def test_missing_time_counts_as_now_or_as_told(spark):
    source = json_df(spark, "{bad")
    today = spark.sql("SELECT current_date() AS d").first().d
    assert build_dim_date(source).first().date == today
    assert build_dim_date(source, "drop").count() == 0
    assert build_dim_date(source, F.lit("2024-02-29").cast("date")).first().date_id == 20240229


def test_weekday_counts_from_sunday(spark):
    df = build_dim_date(json_df(spark, event(time_stamp="2024-06-02T00:00:00Z"), event(time_stamp="2024-06-08T23:59:59Z"),
                                event(time_stamp="2024-06-05T00:00:00Z")))
    found = {r.date_id: (r.weekday, r.weekday_name, r.is_weekend, r.month_name) for r in df.collect()}
    assert found == {20240602: (1, "Sunday", True, "June"), 20240608: (7, "Saturday", True, "June"),
                     20240605: (4, "Wednesday", False, "June")}


def test_product_needs_options_unless_asked(spark):
    source = json_df(spark, event(product_id="1", collection="v"), event(product_id="2", collection="v", option=[]))
    assert build_dim_product(source).count() == 0
    assert rows_of(build_dim_product(source, keep_optionless=True)) == [("1", "v", "xna", "xna"), ("2", "v", "xna", "xna")]


def test_product_takes_the_earliest_option_and_empty_wins_over_later(spark):
    source = json_df(
        spark,
        event(_id="b", time_stamp=2000, product_id="1", collection="v", option=[option("diamond", "late"), option("alloy", "a2")]),
        event(_id="a", time_stamp=1000, product_id="1", collection="v", option=[option("diamond", None), option("diamond", "d1"), option("alloy", "")]),
        event(_id="c", time_stamp=500, product_id="1", collection="v", option=[option("Diamond", "wrong case")]),
        event(_id="d", product_id="1", collection="v", option=[option("diamond", "no time"), option("alloy", "no time")]))
    assert rows_of(build_dim_product(source)) == [("1", "v", "d1", "xna")]


def test_option_dim_keeps_one_value_per_option_or_all(spark):
    source = json_df(spark,
                     event(_id="2", time_stamp=20, option=[option("alloy", "x", "second", "s")]),
                     event(_id="1", time_stamp=10, option=[option("alloy", "x", "first", "f"), option("alloy", "x", "later", "l"),
                                                           option("alloy", None, None, None), option("diamond", "d")]))
    assert rows_of(build_option_dim(source, "alloy")) == [("alloy", "x", "first", "f"), ("alloy", None, None, None)]
    assert build_option_dim(source, "alloy", key="value").count() == 4


def test_customer_filter_and_keys(spark):
    source = json_df(spark,
                     event(_id="1", time_stamp=1, user_id_db=" 7 ", email_address="", show_recommendation="old"),
                     event(_id="2", time_stamp=2, user_id_db="7", email_address="", show_recommendation="new"),
                     event(_id="3", time_stamp=3, user_id_db="7"),
                     event(_id="4", time_stamp=4, user_id_db=" ", email_address=" "),
                     event(_id="5", time_stamp=5))
    assert rows_of(build_dim_customer(source)) == [("7", "", "new"), ("7", None, None)]
    assert rows_of(build_dim_customer(source, null_blank=True)) == [("7", None, None)]


def test_currency_fan_out(spark):
    source = json_df(spark, *[event(currency=c) for c in ("$", "BDT", "EUR", "zz", "", "$")], event(ip="x"))
    counts = {r.raw_currency: r["count"] for r in build_dim_currency(source, spark).groupBy("raw_currency").count().collect()}
    assert counts == {"$": 70, "BDT": 2, "EUR": 1, "zz": 1}
    best = build_dim_currency(source, spark, mode="best", distinct=True)
    assert {r.raw_currency: r.currency_code for r in best.collect()} == {"$": "ARS", "BDT": "BDT", "EUR": "EUR", "zz": None}
    assert len(ROWS) == 170


def test_currency_match_equals_the_or_join(spark):
    reference = currency_list(spark).union(spark.sql(
        "SELECT 'XX' , 'code equals symbol', 'XX', 'XX', CAST(1 AS DECIMAL(18,6)) UNION ALL "
        "SELECT 'YY', 'no symbol', NULL, 'YY', CAST(1 AS DECIMAL(18,6))"))
    raw = spark.createDataFrame([(c,) for c in ("$", "BDT", "XX", "YY", "none", "Fr", "kr")], "raw_currency string")
    plain = raw.join(reference, (raw.raw_currency == reference.symbol) | (raw.raw_currency == reference.currency_code), "left")
    ours = match_currency(raw, "raw_currency", reference)
    assert plain.exceptAll(ours).count() == 0 and ours.exceptAll(plain).count() == 0
    assert currency_keys(reference, "best").groupBy("match_key").count().where("count > 1").count() == 0


# agent, then (type, model, system, browser) under the reference rules and under the precise rules
AGENTS = [
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 13_5 like Mac OS X) Version/13.1 Mobile/15E148 Safari/604.1",
     ("Mobile", "X", "Mac", "Safari"), ("Mobile", "", "iOS", "Safari")),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/18 Safari/537.36 Edge/18.1",
     ("Desktop", "64", "Windows", "Chrome"), ("Desktop", "", "Windows", "Edge")),
    ("Mozilla/5.0 (iPad; CPU OS 13_5) Safari/604.1",
     ("Unknown", "5", "iOS", "Safari"), ("Tablet", "", "iOS", "Safari")),
    ("Mozilla/5.0 (Linux; Android 10; SM-G975F Build/QP1A) Chrome/83.0 Mobile Safari/537.36",
     ("Mobile", "QP1A", "Android", "Chrome"), ("Mobile", "SM-G975F", "Android", "Chrome")),
    ("Mozilla/5.0 (Windows NT 10.0; WOW64; Trident/7.0; rv:11.0) like Gecko",
     ("Desktop", "0", "Windows", "Internet Explorer"), ("Desktop", "", "Windows", "Internet Explorer")),
    ("curl/7.68", ("Unknown", "", "Unknown", "Unknown"), ("Unknown", "", "Unknown", "Unknown")),
    (None, ("Unknown", None, "Unknown", "Unknown"), ("Unknown", None, "Unknown", "Unknown")),
]


@pytest.mark.parametrize("agent, reference, precise", AGENTS)
def test_device_rules(spark, agent, reference, precise):
    source = json_df(spark, event(device_id="d", user_agent=agent))
    assert tuple(build_dim_device(source).first()) == ("d", *reference)
    assert tuple(build_dim_device(source, rules="precise").first()) == ("d", *precise)


def test_device_and_page_tables_keep_event_rows_when_asked(spark):
    source = json_df(spark, *[event(device_id="d", user_agent="curl", product_id="1", current_url="u")] * 3, "{bad")
    assert build_dim_device(source, distinct=False).count() == 4
    assert build_dim_device(source).count() == 2
    assert build_dim_prd(source, distinct=False).count() == 4
    assert rows_of(build_dim_prd(source)) == [("u", "1"), (None, None)]


@pytest.fixture
def merge_tables(spark):
    dim_product = spark.createDataFrame(
        [("1", "v", "d1", "a1"), ("1", "w", "d2", "a2"), ("2", "v", "d3", "a3"), ("9", "v", "d9", "a9"), (None, "v", "x", "x")],
        "product_id string, collection string, diamond_option_id string, alloy_option_id string")
    dim_prd = spark.createDataFrame(
        [("1", "u1", 1), ("1", "u2", 2), ("1", "u2", 2), ("2", "u3", 1), ("9", "u9", 1), (None, "u1", 1)],
        "product_id string, current_url string, t long").withColumn("last_seen", F.timestamp_seconds("t")).drop("t")
    info = spark.createDataFrame(
        [("N1", "1", "x", "u1"), ("N2", "2", "y", "u2"), ("N/A", "N/A", "N/A", "u2"), ("N3", "3", "z", "u3"), ("N9", "9", "z", "u9")],
        "product_name string, price string, description string, current_url string")
    existing = spark.createDataFrame([("9",), ("9",)], "product_id string")
    return dim_product, dim_prd, info, existing


def test_merge_all_multiplies_duplicates_and_skips_known(spark, merge_tables):
    dim_product, dim_prd, info, existing = merge_tables
    merged = merge_product_final(dim_product, dim_prd, info, existing)
    for name, df in (("p", dim_product), ("d", dim_prd), ("i", info), ("f", existing)):
        df.createOrReplaceTempView(name)
    plain = spark.sql("""
        SELECT p.product_id, p.diamond_option_id, p.alloy_option_id, i.product_name, p.collection, i.price, i.description
        FROM p JOIN d ON p.product_id = d.product_id JOIN i ON d.current_url = i.current_url
        LEFT JOIN f ON p.product_id = f.product_id WHERE f.product_id IS NULL""")
    assert rows_of(merged) == rows_of(plain)
    assert merged.count() == 2 * (1 + 2 * 2) + 1


def test_merge_latest_gives_one_row_per_product(merge_tables):
    dim_product, dim_prd, info, existing = merge_tables
    merged = merge_product_final(dim_product, dim_prd, info, existing, mode="latest")
    assert rows_of(merged) == [("1", "d1", "a1", "N2", "v", "2", "y"), ("2", "d3", "a3", "N3", "v", "3", "z")]
    again = merge_product_final(dim_product, dim_prd, info, existing.union(merged.select("product_id")), mode="latest")
    assert again.count() == 0


def test_worklist_skips_fetched_pages(spark):
    prd = spark.createDataFrame([("2", "b"), ("1", "a"), ("1", "a"), ("3", ""), ("4", None), ("5", "c")], "product_id string, current_url string")
    known = spark.createDataFrame([("c",)], "current_url string")
    assert [tuple(r) for r in crawl_worklist(prd, known).collect()] == [("1", "a"), ("2", "b")]
    assert crawl_worklist(prd).count() == 3


def test_quarantine_reasons(spark):
    texts = ["{bad", "", None, "  ", "[1]", '"text"', '{"_id":1,"option":{"a":1}}', '{"_id":"fine"}']
    found = [r.reason for r in checked_events(json_df(spark, *texts), ["_id", "option"]).collect()]
    assert found == ["malformed", "empty", "empty", "empty", "malformed", "malformed", "bad_field", None]


def test_survivors_do_not_depend_on_row_order(spark, lines):
    builders = [build_dim_product, build_dim_customer, build_dim_date, build_dim_device,
                lambda df: build_option_dim(df, "diamond")]
    shuffled = lines.orderBy(F.rand(7)).repartition(5)
    for build in builders:
        assert rows_of(build(lines)) == rows_of(build(shuffled))


@pytest.mark.parametrize("text, amount, currency", [
    ("EUR 1,234.50", "1234.50", "EUR"), ("1.234,50 €", "1234.50", "€"), ("$12", "12.00", "$"),
    ("1 234 kr", "1234.00", "kr"), ("EUR 12.5", "12.50", "EUR"), ("1,234", "1234.00", None),
    ("N/A", None, None), ("", None, None), (None, None, None), ("99999999999 EUR", "99999999999", "EUR"),
    ("VND 125.000.000", "125000000", "VND"), ("EUR 1234.567", "1234.567", "EUR"), ("KWD 12.500", "12.5", "KWD"),
    ("-20 EUR", "-20", "EUR"), ("EUR -1,5", "-1.5", "EUR"), ("1 234,5", "1234.5", None), ("1.234", "1234", None),
    ("1,234,567.89", "1234567.89", None), ("1.234.567", "1234567", None), ("9" * 16, None, None),
])
def test_price_text(spark, text, amount, currency):
    from vitrine.functions.money import price_amount, price_currency

    df = spark.createDataFrame([(text,)], "p string")
    row = df.select(price_amount(F.col("p")).alias("a"), price_currency(F.col("p")).alias("c")).first()
    assert (row.a, row.c) == (None if amount is None else decimal.Decimal(amount), currency)


@pytest.mark.parametrize("url, host, country, campaign", [
    ("https://www.shop.de/a?x=1&utm_campaign=c%201&utm_campaign=z#f", "www.shop.de", "de", "c 1"),
    ("http://user@Shop.CO.UK:8080/a b|c?utm_campaign=", "shop.co.uk", "uk", None),
    ("https://10.0.0.1/x#?utm_campaign=no", "10.0.0.1", None, None),
    ("localhost/x", None, None, None), ("", None, None, None), (None, None, None, None),
    ("https://shop.fr/?my_utm_campaign=no", "shop.fr", "fr", None),
    ("https://shop.fr/?utm_campaign=100%", "shop.fr", "fr", "100%"),
])
def test_url_parts(spark, url, host, country, campaign):
    from vitrine.functions.urls import url_country, url_host, url_parameter

    u = F.col("u")
    row = spark.createDataFrame([(url,)], "u string").select(
        url_host(u), url_country(u), url_parameter(u, "utm_campaign")).first()
    assert tuple(row) == (host, country, campaign)


def test_history_intervals(spark):
    from vitrine.operators.history import product_history

    def at(hour):
        return datetime.datetime(2024, 1, 1, hour)

    versions = spark.createDataFrame(
        [("1", "A", "EUR 1", at(1)), ("1", "A", "EUR 1", at(2)), ("1", "A", "EUR 2", at(3)), ("1", None, "EUR 2", at(4)),
         ("1", None, "EUR 2", at(5)), ("2", "B", None, at(1)), (None, "C", "x", at(1)), ("3", "D", "x", None)],
        "product_id string, product_name string, raw_price string, seen_at timestamp")
    found = [(r.product_id, r.product_name, r.price, r.record_created_date.hour,
              r.record_expired_date and r.record_expired_date.hour, r.is_current_record, r.category)
             for r in product_history(versions).orderBy("product_id", "record_created_date").collect()]
    one, two = decimal.Decimal("1.00"), decimal.Decimal("2.00")
    assert found == [("1", "A", one, 1, 3, False, None), ("1", "A", two, 3, 4, False, None),
                     ("1", None, two, 4, None, True, None), ("2", "B", None, 1, None, True, None)]


def test_structured_prices_and_overflow(spark):
    from vitrine.functions.money import is_overflow, price_amount

    df = spark.createDataFrame([("USD 1.234",), ("EUR 100000000",), ("x",)], "p string")
    p = F.col("p")
    assert [tuple(r) for r in df.select(price_amount(p, structured=True), is_overflow(p)).collect()] == [
        (decimal.Decimal("1.234"), False), (decimal.Decimal("100000000.000"), True), (None, False)]


@pytest.mark.parametrize("text, micros", [
    ("1704110400", 1_704_110_400_000_000), ("1704110400000", 1_704_110_400_000_000),
    ("1704110400000123", 1_704_110_400_000_123), ("1704110400000123456", 1_704_110_400_000_123), ("-5", -5_000_000),
    ("2024-01-01T12:00:00Z", 1_704_110_400_000_000), ("garbage", None), ("1e30", None), (None, None),
])
def test_event_times(spark, text, micros):
    from vitrine.functions.times import event_time

    row = spark.createDataFrame([(text,)], "t string").select(F.unix_micros(event_time(F.col("t")))).first()
    assert row[0] == micros


@pytest.mark.parametrize("text, reason", [
    ('{"time_stamp":"garbage"}', "bad_time"), ('{"time_stamp":{"x":1}}', "bad_time"), ('{"unknown":1}', "no_fields"),
    ("{}", "no_fields"), ('{"_id":"a"}', None), ('{"time_stamp":1704110400}', None), ("[1]", "malformed"), (" ", "empty"),
])
def test_reasons(spark, text, reason):
    from vitrine.operators.quality import checked_events

    df = spark.createDataFrame([(text,)], "json_str string")
    assert checked_events(df, ["collection"]).first().reason == reason
