"""Every registered query agrees with its DuckDB SQL."""

import pytest

import __spark_entry__ as entry
from vitrine.checks.oracles import ORACLES
from vitrine.checks.queries import QUERIES
from tests.compare import connect, differences
from tests.conftest import SF



@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry_runs(spark):
    result = entry.entry(spark)
    assert result.columns == ["product_id", "views"]
    assert result.count() == 10
