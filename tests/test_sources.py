"""Connector options, currency list and file sources."""

import decimal

import pytest

from tests.conftest import rows_of
from vitrine.operators.parse import decode_value
from vitrine.schemas import CURRENCY, EVENT_FIELDS, event_schema
from vitrine.session import work_dir
from vitrine.sources import currency_list, jdbc, kafka
from vitrine.sources.files import append_product_info, product_urls


def test_kafka_options():
    options = kafka.kafka_options("b:9092", "product_view", "SASL_PLAINTEXT", "PLAIN", "me", 'p"\\w')
    assert options["subscribe"] == "product_view" and options["startingOffsets"] == "latest"
    assert options["failOnDataLoss"] == "false"
    assert options["kafka.sasl.jaas.config"].endswith('username="me" password="p\\"\\\\w";')
    assert 'p"' not in str(kafka.redacted(options)) and "***" in str(kafka.redacted(options))
    plain = kafka.kafka_options("b:9092", "t", max_offsets_per_trigger=5)
    assert "kafka.sasl.jaas.config" not in plain and plain["maxOffsetsPerTrigger"] == "5"


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:postgresql://h/db", "dim_date", "u", "p", "org.postgresql.Driver", partitions=4)
    assert options == {"url": "jdbc:postgresql://h/db", "dbtable": "dim_date", "user": "u", "password": "p",
                       "driver": "org.postgresql.Driver", "batchsize": "10000", "numPartitions": "4"}


def test_value_is_decoded(spark):
    df = spark.createDataFrame([(bytearray("{é}", "utf-8"), 1), (None, 2)], "value binary, offset long")
    assert [r.json_str for r in decode_value(df).collect()] == ["{é}", None]


def test_currency_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("﻿" + ",".join(CURRENCY.fieldNames()) + "\nEUR,Euro,€,EU,0.91\nBAD,Bad,b,XX,many\n", encoding="utf-8")
    rows = rows_of(currency_list.read_currency_csv(spark, str(path)))
    assert rows == [("BAD", "Bad", "b", "XX", None), ("EUR", "Euro", "€", "EU", decimal.Decimal("0.910000"))]


def test_built_in_currency_list(spark):
    df = currency_list.currency_list(spark)
    assert df.count() == 170 and df.where("currency_code = 'BDT'").count() == 2
    assert df.where("symbol = '$'").count() == 35
    assert df.where("currency_code = 'UZS'").first().symbol == "so'm"


def test_event_schema_is_narrowed_in_order():
    assert event_schema().fieldNames() == EVENT_FIELDS and len(EVENT_FIELDS) == 19
    assert event_schema(["option", "_id"]).fieldNames() == ["_id", "option"]
    with pytest.raises(ValueError):
        event_schema(["nope"])


def test_product_info_is_appended(spark, tmp_path):
    path = str(tmp_path / "info")
    df = spark.createDataFrame([("n", "p", "d", "u", None), ("n/a", "n/a", "n/a", "v", "Failed to fetch")],
                               "product_name string, price string, description string, current_url string, error string")
    append_product_info(df, path)
    append_product_info(df, path)
    assert rows_of(spark.read.parquet(path)) == sorted([("n", "p", "d", "u", None), ("n/a", "n/a", "n/a", "v", "Failed to fetch")] * 2, key=repr)
    urls = spark.createDataFrame([("2", "b"), ("1", "a"), ("1", "a"), ("3", "")], "product_id string, current_url string")
    assert [tuple(r) for r in product_urls(urls).collect()] == [("1", "a"), ("2", "b")]


def test_work_dir_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if before:
        assert first.startswith(before.rstrip("/"))
