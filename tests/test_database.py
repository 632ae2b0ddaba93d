"""JDBC through the in-memory database of the test process itself."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import plan, same_rows

from millrace import jobs
from millrace.operators.layout import partition_report
from millrace.plans.database import connection
from millrace.scratch import fresh_name
from millrace.sinks import jdbc as sink
from millrace.sources.files import table
from millrace.sources.jdbc import incremental_extract, read_database


@pytest.fixture(scope="module")
def database(spark):
    return connection(spark)


@pytest.fixture(scope="module")
def stored(spark, folder, database):
    name = fresh_name("orders")
    sink.write_database(
        table(spark, folder, "orders"), *database, name, column_types="o_orderstatus VARCHAR(1)"
    )
    return name


def test_parallel_reads(spark, folder, database, stored):
    orders = table(spark, folder, "orders")
    by_range = read_database(spark, *database, stored, partition_column="o_orderkey", partitions=4)
    assert by_range.rdd.getNumPartitions() == 4
    same_rows(by_range, orders)
    parts = ["\"o_orderstatus\" = 'F'", "\"o_orderstatus\" <> 'F'"]
    by_list = read_database(spark, *database, stored, predicates=parts)
    assert by_list.rdd.getNumPartitions() == 2
    same_rows(by_list, orders)


def test_increment_is_filtered_by_the_database(spark, database, stored):
    new = incremental_extract(spark, *database, stored, "o_orderdate", datetime(1998, 6, 1))
    assert "Filter" not in plan(new)
    assert new.agg(F.min("o_orderdate")).first()[0] > datetime(1998, 6, 1)


def test_increment_ranges_are_those_of_the_changed_rows(spark, database, stored):
    new = incremental_extract(
        spark, *database, stored, "o_orderdate", datetime(1998, 6, 1),
        partition_column="o_orderkey", partitions=4,
    )
    sizes = [r["n_rows"] for r in partition_report(new).collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)


def test_query_wins_over_table(spark, database, stored):
    both = read_database(spark, *database, stored, query=f'SELECT "o_orderkey" FROM {stored}')
    assert both.columns == ["o_orderkey"]
    with pytest.raises(ValueError, match="table"):
        read_database(spark, *database)


def test_existing_table(spark, small, database):
    name = fresh_name("region")
    region = table(spark, small, "region")
    assert sink.write_database(region, *database, name) == 5
    with pytest.raises(Exception, match="already exists"):
        sink.write_database(region, *database, name)
    assert sink.write_database(region, *database, name, if_exists="append") == 5
    assert read_database(spark, *database, name).count() == 10
    assert sink.write_database(region, *database, name, if_exists="replace") == 5
    assert read_database(spark, *database, name).count() == 5
    with pytest.raises(ValueError, match="if_exists"):
        sink.write_database(region, *database, name, if_exists="merge")


def test_types_survive(spark, database):
    df = spark.sql(
        """SELECT CAST(3000000000 AS BIGINT) AS big, CAST(1.25 AS DECIMAL(12,2)) AS exact,
                  DATE '2024-02-29' AS day, TRUE AS flag, repeat('x', 300) AS text"""
    )
    name = fresh_name("types")
    sink.write_database(df, *database, name)
    assert read_database(spark, *database, name).first() == df.first()


def test_declared_column_types(spark, database):
    name = fresh_name("declared")
    sink.write_database(spark.range(2).selectExpr("'a' AS s"), *database, name, column_types="s VARCHAR(40)")
    assert read_database(spark, *database, name).count() == 2


def test_append_makes_the_table(spark, small, database):
    region, name = table(spark, small, "region"), fresh_name("made")
    assert sink.write_database(region, *database, name, if_exists="append") == 5
    same_rows(read_database(spark, *database, name), region)


def test_repeated_inserts_are_noticed(spark, small, database, monkeypatch):
    region, name = table(spark, small, "region"), fresh_name("twice")
    counts = iter([10, 5])
    monkeypatch.setattr(sink, "_stored_rows", lambda *a: next(counts))
    assert sink.write_database(region, *database, name) == 5  # the second attempt
    assert read_database(spark, *database, name).count() == 5
    counts = iter([10] * sink.ATTEMPTS)
    with pytest.raises(RuntimeError, match="sent 5 rows, stored 10"):
        sink.write_database(region, *database, name, if_exists="append")
    assert read_database(spark, *database, name).count() == 5  # nothing was appended


def test_extract_then_restore(spark, folder, database, stored, tmp_path):
    path = str(tmp_path / "orders")
    rows = jobs.extract(
        spark, *database, path, table=stored, codec="zstd", partition_by=["o_orderstatus"],
        run_time=datetime(2024, 1, 1),
    )
    assert rows == table(spark, folder, "orders").count()
    name = fresh_name("restored")
    sent = jobs.restore(
        spark, path, *database, name, batch_rows=500,
        transform="SELECT o_orderkey, o_totalprice FROM parquet_view WHERE o_orderstatus = 'F'",
    )
    expected = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    assert sent == expected.count()
    same_rows(read_database(spark, *database, name), expected.select("o_orderkey", "o_totalprice"))


def test_analyze_saves_result_and_counts(spark, folder, tmp_path):
    result, counts = jobs.analyze(
        spark, f"{folder}/part.parquet", "parts", "SELECT COUNT(*) AS n FROM parts",
        column="p_brand", save_to=str(tmp_path / "out"),
    )
    assert result.first()["n"] == table(spark, folder, "part").count()
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["result", "values"]
    values = spark.read.option("header", True).csv(str(tmp_path / "out" / "values" / "p_brand"))
    assert values.count() == counts.count()


def test_analyze_of_a_column_named_result(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "result").write.parquet(str(tmp_path / "in"))
    result, counts = jobs.analyze(
        spark, str(tmp_path / "in"), "t", "SELECT 1 AS one FROM t", column="result", save_to=str(tmp_path / "out")
    )
    assert result.columns == ["one"] and result.count() == 3 and counts.count() == 3


def test_sql_server_address():
    url, properties = jobs.sql_server("host", "db", "me", "secret")
    assert url == "jdbc:sqlserver://host;databaseName=db;trustServerCertificate=true"
    assert properties["user"] == "me"
