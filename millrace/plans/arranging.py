"""Partitioning, clustering, caching and Python functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.exact import exact_sum
from millrace.operators import layout, udfs
from millrace.operators.caching import cached
from millrace.operators.relations import sql_over
from millrace.plans.joining import skewed_events
from millrace.plans.registry import query
from millrace.scratch import fresh_name, fresh_path
from millrace.sources.files import table

ZORDER_COLUMNS = ("p_type", "p_size")
REPORT_PARTITIONS = 16


@query(
    """SELECT event_id, value, CASE WHEN event_type = 'click' THEN 'click' ELSE 'other' END AS kind
       FROM events"""
)
def repartition_key(spark: SparkSession, folder: str) -> DataFrame:
    """By a key of which one value has most of the rows."""
    events, _ = skewed_events(spark, folder)
    return layout.spread_by_key(events, ["kind"], row_key=["event_id"])


@query(
    """SELECT placement, COUNT(*) AS n_rows, TRUE AS ids_differ, TRUE AS ids_in_range,
              TRUE AS one_agrees
       FROM lineitem CROSS JOIN (VALUES ('hash'), ('round robin')) AS p(placement)
       GROUP BY placement"""
)
def partition_report(spark: SparkSession, folder: str) -> DataFrame:
    """Facts about the report that hold wherever the rows are placed.

    ``one_agrees``: the rows picked from one partition are as many as reported.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    placed = {
        "hash": lines.repartition(REPORT_PARTITIONS, "l_orderkey"),
        "round robin": lines.repartition(REPORT_PARTITIONS),
    }
    facts = []
    for name, rows in placed.items():
        report = layout.partition_report(rows)
        picked = rows.where(F.spark_partition_id() == 1).agg(F.count(F.lit(1)).alias("n_picked"))
        summed = report.agg(
            F.sum("n_rows").alias("n_rows"),
            (F.count_distinct("partition_id") == F.count(F.lit(1))).alias("ids_differ"),
            F.bool_and(F.col("partition_id").between(0, REPORT_PARTITIONS - 1)).alias("ids_in_range"),
            F.sum(F.when(F.col("partition_id") == 1, F.col("n_rows"))).alias("n_reported"),
        )
        agrees = F.coalesce("n_reported", F.lit(0)) == picked.scalar()
        facts.append(
            summed.select(
                F.lit(name).alias("placement"), "n_rows", "ids_differ", "ids_in_range",
                agrees.alias("one_agrees"),
            )
        )
    return facts[0].union(facts[1])


@query(
    """SELECT 'flag' AS grouping, l_returnflag AS value, COUNT(*) AS n_lines,
              CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag
       UNION ALL
       SELECT 'status', l_linestatus, COUNT(*),
              CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
       FROM lineitem WHERE l_quantity > 25 GROUP BY l_linestatus"""
)
def cached_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """Two aggregations over one cached subset, which the session's cache keeps."""
    lines = table(spark, folder, "lineitem").where("l_quantity > 25")
    kept = cached(lines.select("l_returnflag", "l_linestatus", "l_extendedprice"))
    totals = [F.count(F.lit(1)).alias("n_lines"), exact_sum("l_extendedprice").alias("total")]

    def by(column: str, label: str) -> DataFrame:
        groups = kept.groupBy(F.col(column).alias("value")).agg(*totals)
        return groups.select(F.lit(label).alias("grouping"), "value", "n_lines", "total")

    return by("l_returnflag", "flag").union(by("l_linestatus", "status"))


@query("SELECT * FROM part")
def zorder_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Clustered by a text and a number."""
    path = fresh_path(spark, "zorder")
    part = table(spark, folder, "part")
    layout.zorder_rewrite(part, ZORDER_COLUMNS, path, partition_by=["p_brand"])
    return spark.read.schema(part.schema).parquet(path)


@query(
    """SELECT l_returnflag, MIN(l_partkey) AS min_value, MAX(l_partkey) AS max_value,
              COUNT(*) AS n_rows, TRUE AS in_order, TRUE AS few_touched
       FROM lineitem GROUP BY l_returnflag"""
)
def file_min_max(spark: SparkSession, folder: str) -> DataFrame:
    """Facts about the files of each folder of a clustered table, however many there are.

    ``in_order``: no file's range reaches into that of a later one.
    ``few_touched``: a reader who looks for the middle value opens two files at most.
    """
    path = fresh_path(spark, "clustered")
    lines = table(spark, folder, "lineitem")
    layout.zorder_rewrite(lines, ["l_partkey"], path, partition_by=["l_returnflag"])
    stored = spark.read.schema(lines.schema).parquet(path)
    # One row per file; a folder's files are few enough for one task.
    report = layout.file_min_max(stored, "l_partkey", ["l_returnflag"])
    whole = Window.partitionBy("l_returnflag")
    ordered = whole.orderBy("min_value", "max_value")
    files = report.withColumns(
        {
            "later": F.lead("min_value").over(ordered),
            "middle": F.floor((F.min("min_value").over(whole) + F.max("max_value").over(whole)) / 2),
        }
    )
    touched = F.col("middle").between(F.col("min_value"), F.col("max_value"))
    return files.groupBy("l_returnflag").agg(
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("n_rows").alias("n_rows"),
        F.bool_and(F.coalesce(F.col("max_value") <= F.col("later"), F.lit(True))).alias("in_order"),
        (F.count_if(touched) <= 2).alias("few_touched"),
    )


_CHARGE_SQL = """SELECT l_orderkey, l_linenumber,
                        l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem"""
_PRICED = ("l_extendedprice", "l_discount", "l_tax")


@query(_CHARGE_SQL)
def udf_scalar(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", udfs.charge(*_PRICED).alias("charge"))


@query(_CHARGE_SQL)
def udf_sql(spark: SparkSession, folder: str) -> DataFrame:
    view = fresh_name("lines")
    with udfs.registered_charge(spark) as charge:
        return sql_over(
            spark,
            f"SELECT l_orderkey, l_linenumber, {charge}({', '.join(_PRICED)}) AS charge FROM {view}",
            **{view: table(spark, folder, "lineitem")},
        )


@query(_CHARGE_SQL)
def udf_native(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", udfs.native_charge(*_PRICED).alias("charge"))
