"""Scans of each file format, of inline rows, ranges and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.exact import MONEY
from millrace.operators.aggregates import rows_and_values
from millrace.operators.joins import keyed_join
from millrace.plans.registry import query
from millrace.scratch import fresh_name, fresh_path
from millrace.sinks.files import write_parquet
from millrace.sources.files import footer_facts, read_csv, read_nested_folders, table, with_source_file
from millrace.sources.inline import inline_rows, steps_between

_STATUS_ROWS = [("F", "finished"), ("O", "open")]
CUSTOMER_DDL = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
ORDERS_DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
PART_DDL = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double"
)


@query(
    """SELECT o_orderkey, o_orderstatus, status_name FROM orders
       LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) AS s(status, status_name)
       ON o_orderstatus = status"""
)
def src_inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    names = inline_rows(spark, _STATUS_ROWS, "status string, status_name string")
    orders = table(spark, folder, "orders")
    # Two rows by construction.
    joined = orders.join(F.broadcast(names), orders.o_orderstatus == names.status, "left")
    return joined.select("o_orderkey", "o_orderstatus", "status_name")


@query(
    """WITH bands AS (SELECT CAST(floor(o_totalprice / 10000) AS BIGINT) * 10000 AS band,
                             COUNT(*) AS n FROM orders GROUP BY 1),
            steps AS (SELECT unnest(range((SELECT min(band) FROM bands),
                                          (SELECT max(band) + 1 FROM bands), 10000)) AS price_from)
       SELECT price_from, COALESCE(n, 0) AS n_orders
       FROM steps LEFT JOIN bands ON price_from = band"""
)
def range_source(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per price band, empty bands included."""
    orders = table(spark, folder, "orders")
    steps = steps_between(spark, orders, "o_totalprice", 10000, "price_from")
    band = (F.floor(F.col("o_totalprice") / 10000) * 10000).cast("bigint")
    counts = orders.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))
    joined = steps.join(counts, F.col("price_from") == F.col("band"), "left")
    return joined.select("price_from", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("SELECT * FROM customer")
def csv_infer_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Inferred keys are as narrow as the data allows, hence the casts."""
    path = fresh_path(spark, "csv-infer")
    table(spark, folder, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path).withColumns(
        {
            "c_custkey": F.col("c_custkey").cast("bigint"),
            "c_nationkey": F.col("c_nationkey").cast("int"),
            "c_acctbal": F.col("c_acctbal").cast("double"),
        }
    )


@query("SELECT * FROM orders")
def csv_schema_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv-schema")
    table(spark, folder, "orders").write.option("header", True).csv(path)
    return read_csv(spark, path, ORDERS_DDL)


def dirty_customers(spark: SparkSession, folder: str) -> str:
    """Customer lines without header; those of four nations do not fit the schema."""
    nation = F.col("c_nationkey")
    since = F.date_add(F.lit("2020-01-01").cast("date"), nation).cast("string")
    first = F.concat_ws(
        ",",
        F.col("c_custkey").cast("string"),
        "c_name",
        F.when(nation == 0, "none").otherwise(nation.cast("string")),
    )
    rest = F.concat_ws(
        ",",
        F.col("c_acctbal").cast(MONEY).cast("string"),
        "c_mktsegment",
        F.when(nation == 1, "soon").otherwise(since),
        F.when(nation == 2, "extra"),
    )
    line = F.when(nation == 3, first).otherwise(F.concat_ws(",", first, rest))
    path = fresh_path(spark, "csv-dirty")
    table(spark, folder, "customer").select(line.alias("value")).write.text(path)
    return path


DIRTY_DDL = f"{CUSTOMER_DDL}, c_since date"
_LINE_SQL = """CAST(c_custkey AS VARCHAR) || ',' || c_name || ','
    || CASE WHEN c_nationkey = 0 THEN 'none' ELSE CAST(c_nationkey AS VARCHAR) END
    || CASE WHEN c_nationkey = 3 THEN ''
            ELSE ',' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || ',' || c_mktsegment
                 || ',' || CASE WHEN c_nationkey = 1 THEN 'soon'
                                ELSE CAST(CAST(DATE '2020-01-01' + c_nationkey AS DATE) AS VARCHAR)
                           END
                 || CASE WHEN c_nationkey = 2 THEN ',extra' ELSE '' END
       END"""


@query(
    f"""SELECT c_custkey, c_name, CASE WHEN c_nationkey <> 0 THEN c_nationkey END AS c_nationkey,
               CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS c_acctbal,
               CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS c_mktsegment,
               CASE WHEN c_nationkey NOT IN (1, 3)
                    THEN CAST(DATE '2020-01-01' + c_nationkey AS DATE) END AS c_since,
               CASE WHEN c_nationkey < 4 THEN {_LINE_SQL} END AS bad_record
        FROM customer"""
)
def csv_permissive(spark: SparkSession, folder: str) -> DataFrame:
    path = dirty_customers(spark, folder)
    return read_csv(spark, path, DIRTY_DDL, bad_record="bad_record", header=False)


@query(
    """SELECT *, CAST(DATE '2020-01-01' + c_nationkey AS DATE) AS c_since
       FROM customer WHERE c_nationkey >= 4"""
)
def csv_dropmalformed(spark: SparkSession, folder: str) -> DataFrame:
    path = dirty_customers(spark, folder)
    return read_csv(spark, path, DIRTY_DDL, mode="DROPMALFORMED", header=False)


@query("SELECT * FROM customer")
def csv_failfast(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv-failfast")
    table(spark, folder, "customer").write.option("header", True).csv(path)
    return read_csv(spark, path, CUSTOMER_DDL, mode="FAILFAST")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def parquet_scan(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem*.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@query("SELECT * FROM part")
def orc_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "orc")
    table(spark, folder, "part").write.orc(path)
    return spark.read.orc(f"{path}/*.orc")


@query("SELECT * FROM orders")
def recursive_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Folders two levels deep, whose names do not become columns."""
    path = fresh_path(spark, "nested-folders")
    levels = {"year": F.year("o_orderdate"), "status": F.col("o_orderstatus")}
    nested = table(spark, folder, "orders").withColumns(levels).hint("rebalance", "year", "status")
    nested.write.partitionBy("year", "status").parquet(path)
    return read_nested_folders(spark, path)


@query("SELECT * FROM customer")
def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    name = fresh_name("customer")
    path = fresh_path(spark, "catalog-table")
    table(spark, folder, "customer").write.mode("error").option("path", path).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay, and the frame knows them
    return stored


@query(
    """SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus AS folder, TRUE AS named,
              COUNT(*) OVER (PARTITION BY o_orderstatus) AS folder_rows
       FROM orders"""
)
def source_file(spark: SparkSession, folder: str) -> DataFrame:
    """The file of every row, of which the folder is known beforehand, and the rows per folder.

    ``named``: the file's name is one that the writer gives. Rows are counted by file, map-side,
    and the counts of a folder's few files added up.
    """
    path = fresh_path(spark, "by-status")
    write_parquet(table(spark, folder, "orders"), path, partition_by=["o_orderstatus"])
    stored = spark.read.schema(ORDERS_DDL).parquet(path)
    rows = with_source_file(stored, "file").select(
        "o_orderkey", F.element_at(F.split("file", "/"), -2).alias("folder"), "file"
    )
    counts = rows.groupBy("folder", "file").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy(F.col("folder").alias("of_folder")).agg(F.sum("n").alias("folder_rows"))
    joined = keyed_join(rows, sums, ["folder"], ["of_folder"], "left", row_key=["o_orderkey"])
    named = F.col("file").rlike(r"/part-[^/]+\.parquet$").alias("named")
    return joined.select("o_orderkey", "folder", named, "folder_rows")


@query("SELECT COUNT(*) AS n_rows, MIN(l_orderkey) AS first_key, MAX(l_orderkey) AS last_key FROM lineitem")
def footer_count(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and ends of a column from the files' footers; no row is read."""
    return footer_facts(spark, f"{folder}/lineitem.parquet", "l_orderkey", "n_rows", "first_key", "last_key")


@query("SELECT COUNT(*) AS n_rows, COUNT(l_orderkey) AS n_l_orderkey FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return rows_and_values(table(spark, folder, "lineitem"), ["l_orderkey"])
