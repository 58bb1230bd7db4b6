"""Registered queries that have SQL agree with it."""

import pytest

from vitrine.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
