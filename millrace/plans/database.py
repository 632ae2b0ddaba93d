"""Queries that go through a database.

They use the one named by the session settings below. Where none is named and
Spark runs in one process, they use an in-memory Derby of that process, which
listens nowhere; executors in other processes could not see it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from millrace.jobs import restore
from millrace.plans.registry import query
from millrace.scratch import fresh_name, fresh_path
from millrace.sinks.jdbc import write_database
from millrace.sources.files import table
from millrace.sources.jdbc import incremental_extract as changed_rows
from millrace.sources.jdbc import read_database

URL_SETTING = "spark.millrace.jdbc.url"
PROPERTY_SETTINGS = ("driver", "user", "password")
_IN_PROCESS = "jdbc:derby:memory:millrace;create=true"
_DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def connection(spark: SparkSession) -> tuple[str, dict[str, str]]:
    url = spark.conf.get(URL_SETTING, None)
    if url:
        named = {p: spark.conf.get(f"spark.millrace.jdbc.{p}", None) for p in PROPERTY_SETTINGS}
        return url, {p: v for p, v in named.items() if v}
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {URL_SETTING} to a database that every executor can reach")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return _IN_PROCESS, {"driver": _DERBY_DRIVER}


def _partitions(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


@query("SELECT * FROM supplier")
def jdbc_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    url, properties = connection(spark)
    name = fresh_name("supplier")
    write_database(table(spark, folder, "supplier"), url, properties, name)
    return read_database(
        spark, url, properties, name,
        partition_column="s_suppkey", partitions=_partitions(spark),
    )


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 3")
def jdbc_query_scan(spark: SparkSession, folder: str) -> DataFrame:
    url, properties = connection(spark)
    name = fresh_name("supplier")
    write_database(table(spark, folder, "supplier"), url, properties, name)
    wanted = f'SELECT "s_suppkey", "s_name" FROM {name} WHERE "s_nationkey" = 3'
    return read_database(spark, url, properties, table=name, query=wanted)


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'")
def incremental_extract(spark: SparkSession, folder: str) -> DataFrame:
    url, properties = connection(spark)
    name = fresh_name("orders")
    write_database(table(spark, folder, "orders"), url, properties, name)
    return changed_rows(
        spark, url, properties, name, "o_orderdate", datetime(1998, 1, 1),
        partition_column="o_orderkey", partitions=_partitions(spark),
    )


@query("SELECT * FROM supplier")
def jdbc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    url, properties = connection(spark)
    name = fresh_name("supplier")
    supplier = table(spark, folder, "supplier")
    write_database(supplier, url, properties, name)
    write_database(supplier, url, properties, name, if_exists="replace")
    return read_database(spark, url, properties, name)


@query("SELECT * FROM part UNION ALL SELECT * FROM part")
def jdbc_append(spark: SparkSession, folder: str) -> DataFrame:
    url, properties = connection(spark)
    name = fresh_name("part")
    part = table(spark, folder, "part")
    for _ in range(2):  # the first makes the table
        write_database(part, url, properties, name, if_exists="append", batch_rows=2000)
    return read_database(spark, url, properties, name)


@query(
    """SELECT p_partkey, p_name, p_retailprice * 2 AS doubled_price FROM part WHERE p_size > 10"""
)
def restore_transform(spark: SparkSession, folder: str) -> DataFrame:
    url, properties = connection(spark)
    name = fresh_name("restored")
    path = fresh_path(spark, "to-restore")
    table(spark, folder, "part").write.parquet(path)
    restore(
        spark, path, url, properties, name,
        transform="SELECT p_partkey, p_name, p_retailprice * 2 AS doubled_price "
        "FROM parquet_view WHERE p_size > 10",
    )
    return read_database(spark, url, properties, name)
