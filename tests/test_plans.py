"""Plans keep the shape that scales."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from vitrine.checks import queries as q
from vitrine.operators.currency import build_dim_currency
from vitrine.operators.customers import build_dim_customer
from vitrine.operators.products import build_dim_prd
from vitrine.operators.facts import write_fact, build_fact_event
from vitrine.plans.products import top_products

STREAMS = [n for n in q.QUERIES if n.startswith("stream_")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in q.QUERIES if n not in STREAMS])
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(q.QUERIES[name](spark, SF))
    for word in ("NestedLoop", "CartesianProduct", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in text


def test_currency_match_is_a_hash_join(lines, spark):
    text = plan(build_dim_currency(lines, spark))
    assert "BroadcastHashJoin" in text


def test_each_text_is_parsed_once_with_a_narrow_schema(lines):
    text = plan(build_dim_customer(lines))
    assert text.count("from_json(") == 1
    assert "user_agent" not in text.split("from_json(")[1].split("json_str")[0]
    assert plan(build_dim_prd(lines).select("product_id")).count("from_json(") == 1


def test_the_country_of_an_event_is_found_once(lines):
    facts = build_fact_event(lines, ["store_id", "country_code", "store_key"])
    project = [line for line in plan(facts).splitlines() if "md5(" in line]
    assert project and "regexp_extract" not in project[0]


def test_analytics_read_only_their_columns_of_the_stored_fact(spark):
    text = plan(top_products(q.fact(spark, SF)))
    scan = text[text.index("ReadSchema"):].splitlines()[0]
    assert "collection" in scan and "product_id" in scan and "device_id" not in scan
    assert "EqualTo(collection,view_product_detail)" in text
    assert "TakeOrderedAndProject" in text


def test_fact_dates_prune_partitions(spark, lines, tmp_path):
    path = str(tmp_path / "fact")
    write_fact(build_fact_event(lines, ["event_id", "date_id"]), path)
    write_fact(build_fact_event(lines, ["event_id", "date_id"]).where("date_id = 20240105"), path, "overwrite")
    assert spark.read.parquet(path).count() == lines.count()
    df = spark.read.parquet(path).where(F.col("date_id") == 20240105)
    assert "PartitionFilters: [isnotnull(date_id" in plan(df)
    assert 0 < df.count() < spark.read.parquet(path).count()
