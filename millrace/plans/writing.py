"""Each sink writes to a new folder; the query is what is read back."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.jobs import analyze
from millrace.plans.reading import CUSTOMER_DDL, ORDERS_DDL, PART_DDL
from millrace.operators.concurrent import run_together
from millrace.operators.relations import sql_over
from millrace.plans.registry import query
from millrace.scratch import fresh_name, fresh_path
from millrace.sinks import versions
from millrace.sinks.files import (
    CODECS,
    stamp,
    write_keyed_extracts,
    write_parquet,
    write_single_file,
)
from millrace.sources.files import read_csv, table

RUN_TIME = datetime(2024, 5, 17, 8, 30, 0)
ZONE_FILES = 16
SEGMENTS = ("Building", "machinery", "FURNITURE", "household")


@query("SELECT * FROM part")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    table(spark, folder, "part").write.option("header", True).csv(path)
    return read_csv(spark, path, PART_DDL)


@query("SELECT * FROM orders")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "parquet")
    write_parquet(table(spark, folder, "orders"), path)
    return spark.read.parquet(path)


@query(
    """SELECT codec, part.* FROM part
       CROSS JOIN (VALUES ('snappy'), ('gzip'), ('zstd'), ('none')) AS c(codec)"""
)
def parquet_codecs(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    copies = []
    for codec in CODECS:
        path = fresh_path(spark, f"parquet-{codec}")
        write_parquet(part, path, codec=codec)
        copies.append(spark.read.parquet(path).select(F.lit(codec).alias("codec"), "*"))
    return reduce(DataFrame.unionByName, copies)


@query("SELECT * FROM orders")
def partitioned_write(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "partitioned")
    write_parquet(table(spark, folder, "orders"), path, partition_by=["o_orderstatus"])
    return spark.read.schema(ORDERS_DDL).parquet(path)


@query(
    """SELECT 'error' AS mode, COUNT(*) AS n_rows FROM supplier
       UNION ALL SELECT 'append', 2 * COUNT(*) FROM supplier
       UNION ALL SELECT 'overwrite', COUNT(*) FROM supplier
       UNION ALL SELECT 'ignore', COUNT(*) FROM supplier"""
)
def write_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows present after a first write and a second one in the given mode."""
    supplier = table(spark, folder, "supplier")
    counts = []
    for mode in ("error", "append", "overwrite", "ignore"):
        path = fresh_path(spark, f"mode-{mode}")
        supplier.write.mode("error").parquet(path)
        if mode != "error":
            supplier.write.mode(mode).parquet(path)
        rows = F.count(F.lit(1)).alias("n_rows")
        counts.append(spark.read.parquet(path).agg(rows).select(F.lit(mode).alias("mode"), "n_rows"))
    return reduce(DataFrame.unionByName, counts)


@query(
    """SELECT o_orderpriority, COUNT(*) AS n_orders, CAST(1 AS BIGINT) AS n_files
       FROM orders GROUP BY o_orderpriority"""
)
def single_file_write(spark: SparkSession, folder: str) -> DataFrame:
    """A small report as one file."""
    path = fresh_path(spark, "single-file")
    counts = table(spark, folder, "orders").groupBy("o_orderpriority")
    write_single_file(counts.agg(F.count(F.lit(1)).alias("n_orders")), path, header=True)
    written = read_csv(spark, path, "o_orderpriority string, n_orders bigint")
    files = written.select(F.countDistinct("_metadata.file_path")).scalar()
    return written.withColumn("n_files", files)


@query("SELECT *, '2024-05-17 08:30:00' AS extraction_timestamp FROM supplier")
def extraction_stamp(spark: SparkSession, folder: str) -> DataFrame:
    return stamp(table(spark, folder, "supplier"), RUN_TIME)


@query(
    """SELECT *, lower(c_mktsegment) AS extract_key FROM customer
       WHERE lower(c_mktsegment) IN ('building', 'machinery', 'furniture', 'household')"""
)
def keyed_extracts(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "extracts")
    customer = table(spark, folder, "customer")
    write_keyed_extracts(customer, "c_mktsegment", SEGMENTS, path, header=True)
    return read_csv(spark, path, f"{CUSTOMER_DDL}, extract_key string")


@query(
    """SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000"""
)
def lake_table_prune(spark: SparkSession, folder: str) -> DataFrame:
    """A filter on the folder column and one inside the files."""
    path = fresh_path(spark, "lake")
    write_parquet(table(spark, folder, "customer"), path, partition_by=["c_mktsegment"])
    stored = spark.read.schema(CUSTOMER_DDL).parquet(path)
    return stored.where("c_mktsegment = 'BUILDING' AND c_acctbal > 5000")


_CHANGED_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 3 YEAR ELSE o_orderdate END AS o_orderdate,
         o_orderpriority FROM orders"""


@query(_CHANGED_SQL)
def incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Four pulls by high-water mark: the orders to 1996, all orders, and twice what changed since."""
    orders = table(spark, folder, "orders")
    changes = F.col("o_orderkey") % 7 == 0
    later = orders.withColumns(
        {
            "o_totalprice": F.when(changes, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")),
            "o_orderdate": F.when(changes, F.expr("o_orderdate + INTERVAL 3 YEARS")).otherwise(F.col("o_orderdate")),
        }
    )
    root = fresh_path(spark, "orders-by-increments")
    for now in (orders.where("o_orderdate < TIMESTAMP_NTZ'1996-01-01'"), orders, later, later):

        def source(since: datetime | None, now: DataFrame = now) -> DataFrame:
            return now if since is None else now.where(F.col("o_orderdate") > F.lit(since).cast("timestamp_ntz"))

        at = versions.pull(spark, root, source, ["o_orderkey"], "o_orderdate", overlap=timedelta(days=365 * 4))
    return versions.read(spark, at)


@query(
    """SELECT reader, orders.* FROM orders CROSS JOIN (VALUES ('before'), ('after')) AS r(reader)"""
)
def lake_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """A partition clustered in place, for a reader that came before and one that came after."""
    root = fresh_path(spark, "versioned")
    orders = table(spark, folder, "orders")
    before = versions.create(orders, root, ["o_orderstatus", "o_custkey"], cluster_by=["o_orderstatus"])
    old = versions.read(spark, before)
    after = versions.rewrite(spark, root, {"o_orderstatus": ("F", "F")}, ["o_custkey"])
    new = versions.read(spark, after)
    return old.select(F.lit("before").alias("reader"), "*").union(new.select(F.lit("after").alias("reader"), "*"))


@query(
    """SELECT *, TRUE AS few_files FROM lineitem
       WHERE l_partkey BETWEEN 100 AND 120 AND l_suppkey <= 40"""
)
def zone_map_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Only files whose ranges of both columns meet the wanted ones are opened."""
    root = fresh_path(spark, "zoned")
    lines = table(spark, folder, "lineitem")
    at = versions.create(lines, root, ["l_partkey", "l_suppkey"], files=ZONE_FILES)
    wanted = {"l_partkey": (100, 120), "l_suppkey": (None, 40)}
    rows = versions.read(spark, at, wanted)
    few = len(rows.inputFiles()) < versions.manifest(spark, at).count()
    return rows.withColumn("few_files", F.lit(few))


@query(
    """SELECT 'result' AS report, o_orderstatus AS value, COUNT(*) AS n_rows FROM orders
       WHERE o_totalprice > 100000 GROUP BY o_orderstatus
       UNION ALL SELECT 'values', o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority"""
)
def saved_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """The result of a query and the frequencies of a column, both saved and read back."""
    path = fresh_path(spark, "analysis")
    result, values = analyze(
        spark, f"{folder}/orders.parquet", "orders_to_analyze",
        "SELECT o_orderstatus AS value, COUNT(*) AS n_rows FROM orders_to_analyze "
        "WHERE o_totalprice > 100000 GROUP BY o_orderstatus",
        column="o_orderpriority", save_to=path,
    )
    label = F.lit("result").alias("report")
    frequencies = values.select(F.lit("values").alias("report"), F.col("o_orderpriority").alias("value"), "n_rows")
    return result.select(label, "value", "n_rows").union(frequencies)


_EXTRACTS = {
    "rich": ("customer", "SELECT c_custkey AS key, c_name AS label FROM {t} WHERE c_acctbal > 5000"),
    "urgent": ("orders", "SELECT o_orderkey AS key, o_orderstatus AS label FROM {t} WHERE o_orderpriority = '1-URGENT'"),
    "large": ("part", "SELECT p_partkey AS key, p_brand AS label FROM {t} WHERE p_size > 40"),
    "returned": ("lineitem", "SELECT l_orderkey AS key, l_linestatus AS label FROM {t} WHERE l_returnflag = 'R'"),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS extract, * FROM ({text.format(t=source)})" for name, (source, text) in _EXTRACTS.items()
    )
)
def concurrent_extracts(spark: SparkSession, folder: str) -> DataFrame:
    """Four different extracts of four tables, written at the same time."""
    root = fresh_path(spark, "concurrent")
    views = {name: fresh_name(source) for name, (source, _) in _EXTRACTS.items()}
    frames = {
        name: sql_over(spark, text.format(t=views[name]), **{views[name]: table(spark, folder, source)})
        for name, (source, text) in _EXTRACTS.items()
    }
    run_together(
        spark, {name: lambda df=df, name=name: write_parquet(df, f"{root}/{name}") for name, df in frames.items()}
    )
    return reduce(
        DataFrame.union,
        [spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("extract"), "*") for name in _EXTRACTS],
    )
