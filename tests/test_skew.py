"""Registered queries on tables in which one value holds a third of the rows."""

import duckdb
import pytest
from oracle import TABLES, assert_same, connect
from rows import plan

import __spark_entry__ as entry_point
from millrace.operators import joins

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()

# A third of the lines are copies of one line, and a sixth have one order and part.
LINEITEM = """
    WITH numbered AS (SELECT *, row_number() OVER () AS rn FROM source)
    SELECT * EXCLUDE rn REPLACE (CASE WHEN rn % 6 = 1 THEN 5 ELSE l_orderkey END AS l_orderkey,
                                 CASE WHEN rn % 6 = 1 THEN 9 ELSE l_partkey END AS l_partkey)
    FROM numbered WHERE rn % 3 <> 0
    UNION ALL
    SELECT one.* EXCLUDE rn FROM numbered one, numbered other
    WHERE one.rn = 17 AND other.rn % 3 = 0"""
CHANGED = {
    "lineitem": LINEITEM,
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END
                                   AS o_custkey) FROM source""",
    "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END
                                     AS c_nationkey) FROM source""",
}


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    path = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in TABLES:
        source = f"read_parquet('{folder}/{name}.parquet')"
        rows = CHANGED.get(name, "SELECT * FROM source").replace("source", source)
        connection.execute(
            f"COPY ({rows}) TO '{path}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 10000)"
        )
    return str(path)


@pytest.fixture
def nothing_is_broadcast(monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_LIMIT_BYTES", 0)


@pytest.mark.parametrize(
    "name",
    """agg_global bucketed_join dict_lookup distinct_rows file_min_max join_broadcast
    join_compound join_inner join_left join_merge join_salted join_shuffle_hash join_skewed
    join_using partitioned_write repartition_key revenue_by_nation window_max window_nth
    window_sql zorder_rewrite""".split(),
)
def test_skewed_tables(spark, skewed, nothing_is_broadcast, name):
    assert_same(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name])


@pytest.mark.parametrize("name", "join_inner join_left join_merge join_using".split())
def test_hot_keys_are_salted(spark, skewed, nothing_is_broadcast, name):
    assert "_salt" in plan(QUERIES[name](spark, skewed))


def test_hot_groups_are_not_windowed(spark, skewed, nothing_is_broadcast):
    assert "Window" not in plan(QUERIES["window_max"](spark, skewed))


@pytest.mark.parametrize("name", "bucketed_join join_salted repartition_key window_max".split())
def test_given_tables_take_the_salted_plans(spark, folder, name):
    assert "_salt" in plan(QUERIES[name](spark, folder))


def test_nothing_is_left_behind(spark, folder):
    def functions():
        return {f.name for f in spark.catalog.listFunctions() if "charge" in f.name}

    tables = {t.name for t in spark.catalog.listTables()}
    for name in ("bucketed_join", "udf_sql"):
        assert QUERIES[name](spark, folder).count() > 0
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert not functions()
