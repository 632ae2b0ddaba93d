"""Queries of the llm operators against their SQL."""

import pytest
from oracle import assert_same, connect

from millrace.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, name):
    assert_same(QUERIES[name](spark, folder), connect(folder), ORACLES[name])
