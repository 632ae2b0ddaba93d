"""Every registered query against its SQL."""

import pytest
from oracle import assert_same, connect

import __spark_entry__ as entry_point
from millrace.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, folder, name):
    assert_same(QUERIES[name](spark, folder), duck, ORACLES[name])


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_counting_agrees_with_collecting(spark, folder):
    for name in ("csv_dropmalformed", "csv_permissive", "csv_failfast"):
        result = QUERIES[name](spark, folder)
        assert result.count() == len(result.collect())


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 25
