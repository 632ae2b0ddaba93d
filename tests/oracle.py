"""Comparing a DataFrame with what DuckDB computes over the same files."""

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _kind(value):
    for kind in (bool, int, float, str, datetime.datetime, datetime.date, decimal.Decimal):
        if isinstance(value, kind):
            return kind.__name__
    return type(value).__name__


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple((row[i] is not None, _kind(row[i]), row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(keyed, key=repr)


# DuckDB's and Spark's names for the types that occur in results.
SAME_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def assert_same(result, connection, sql):
    relation = connection.sql(sql)
    expected_types = {c: SAME_TYPES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert dict(result.dtypes) == expected_types
    got_columns, got = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    columns, expected = _sorted_rows(relation.columns, relation.fetchall())
    assert got_columns == columns
    assert len(got) == len(expected)
    for one, other in zip(got, expected):
        assert one == other
