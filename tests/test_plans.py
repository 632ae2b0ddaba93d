"""The plans of registered queries, as far as they matter at scale."""

import pytest
from rows import plan

import __spark_entry__  # noqa: F401  registers the queries
from millrace.plans.registry import QUERIES


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("filter_sql", "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,30.0)]"),
        ("sql_filter", "EqualTo(c_nationkey,1)"),
        ("computed_column", "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double>"),
        ("join_broadcast", "BroadcastHashJoin"),
        ("join_broadcast_sql", "BroadcastHashJoin"),
        ("join_merge", "SortMergeJoin"),
        ("join_salted", "SortMergeJoin"),
        ("join_shuffle_hash", "ShuffledHashJoin"),
        ("cached_reuse", "InMemoryTableScan"),
        ("top_k", "TakeOrderedAndProject"),
        ("window_nth", "WindowGroupLimit"),
        ("window_sql", "WindowGroupLimit"),
    ],
)
def test_plan_contains(spark, folder, name, wanted):
    assert wanted in plan(QUERIES[name](spark, folder))


def test_bucketed_join_has_no_exchange(spark, folder):
    assert "Exchange" not in plan(QUERIES["bucketed_join"](spark, folder))


def test_no_cross_joins_and_python_only_in_udfs(spark, folder):
    for name, query in QUERIES.items():
        text = plan(query(spark, folder))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
        assert ("Python" in text or "ArrowEval" in text) == (name in ("udf_scalar", "udf_sql")), name
