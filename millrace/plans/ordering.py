"""Windows, sorts, limits and set operations.

Sort keys end in a unique column: ranges of a sort are cut between different
keys, so a value shared by many rows would otherwise fill one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.exact import exact
from millrace.operators import sorting
from millrace.operators.scans import group_ranks
from millrace.operators.windows import nth_in_group, window_max as max_over_group
from millrace.plans.joining import skewed_events
from millrace.plans.registry import query
from millrace.scratch import fresh_path
from millrace.sources.files import table


@query(
    """SELECT event_id, value, kind, MAX(value) OVER (PARTITION BY kind) AS max_value
       FROM (SELECT event_id, value, CASE WHEN event_type = 'click' THEN 'click'
                                          ELSE 'other' END AS kind FROM events)"""
)
def window_max(spark: SparkSession, folder: str) -> DataFrame:
    """Over groups of which one has most of the rows."""
    events, _ = skewed_events(spark, folder)
    return max_over_group(events, ["kind"], "value", "max_value", row_key=["event_id"])


@query(
    """SELECT * FROM (SELECT o_orderkey, o_custkey, o_totalprice,
                             CAST(row_number() OVER (PARTITION BY o_custkey
                                  ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn
                      FROM orders) WHERE rn = 2"""
)
def window_nth(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return nth_in_group(orders, ["o_custkey"], order, 2)


@query(
    """SELECT * FROM (SELECT l_orderkey, l_extendedprice, l_partkey,
                             CAST(row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_extendedprice DESC, l_partkey) AS INTEGER) AS rn
                      FROM lineitem) WHERE rn = 2"""
)
def window_sql(spark: SparkSession, folder: str) -> DataFrame:
    number = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey)"
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_partkey")
    return lines.withColumn("rn", F.expr(number)).where("rn = 2")


_RANKED_SQL = """SELECT event_id, kind, value,
         row_number() OVER (w ORDER BY value DESC, event_id) AS row_number,
         rank() OVER (w ORDER BY value DESC) AS rank,
         dense_rank() OVER (w ORDER BY value DESC) AS dense_rank,
         count(*) OVER w AS group_rows,
         percent_rank() OVER (w ORDER BY value DESC) AS percent_rank,
         CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (w ORDER BY value DESC, event_id
              ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_value
       FROM {events} WINDOW w AS (PARTITION BY kind)"""


def _ranked(events: DataFrame) -> DataFrame:
    ranked = group_ranks(
        events, ["kind"], ["-value"], row_key=["event_id"], running={"running_value": exact("value")}
    )
    share = F.when(F.col("group_rows") == 1, 0.0).otherwise(
        (F.col("rank") - 1).cast("double") / (F.col("group_rows") - 1)
    )
    return ranked.withColumns(
        {"percent_rank": share, "running_value": F.col("running_value").cast("double")}
    )


@query(
    _RANKED_SQL.format(
        events="""(SELECT event_id, value, CASE WHEN event_type = 'click' THEN 'click'
                                                ELSE 'other' END AS kind FROM events)"""
    )
)
def window_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """All ranks and a running sum of whole groups, one of which has most of the rows."""
    events, _ = skewed_events(spark, folder)
    return _ranked(events)


@query(
    _RANKED_SQL.format(
        events="(SELECT event_id, event_type AS kind, floor(value / 10) AS value FROM events)"
    )
)
def window_ties(spark: SparkSession, folder: str) -> DataFrame:
    """The same by event type and tens, where many rows share an order value."""
    tens = F.floor(F.col("value") / 10).cast("double").alias("value")
    events = table(spark, folder, "events")
    return _ranked(events.select("event_id", F.col("event_type").alias("kind"), tens))


@query("SELECT * FROM supplier ORDER BY s_acctbal, s_suppkey")
def sort_asc(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").orderBy(F.col("s_acctbal").asc(), "s_suppkey")


@query("SELECT * FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort_multi(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.orderBy("c_mktsegment", F.col("c_acctbal").desc(), "c_custkey")


@query(
    """SELECT l_returnflag, COUNT(*) AS n_rows, TRUE AS files_in_order, TRUE AS in_order, TRUE AS balanced
       FROM lineitem GROUP BY l_returnflag"""
)
def sort_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Lines sorted by a column of three values, written, and what their files look like.

    ``files_in_order``: no file holds a value below one of the files before it.
    ``in_order``: within a file equal values follow each other, in order.
    ``balanced``: no file has more than twice the rows of an even share.
    """
    path = fresh_path(spark, "sorted")
    lines = table(spark, folder, "lineitem")
    sorting.write_sorted(lines, ["l_returnflag"], path)
    runs = sorting.runs_in_files(spark.read.schema(lines.schema).parquet(path), "l_returnflag")
    # One row per file.
    files = sorting.file_facts(runs)
    by_name = Window.orderBy("file_name")
    files = files.withColumn("before", F.lag("max_value").over(by_name))
    facts = files.agg(
        F.bool_and(F.coalesce(F.col("before") <= F.col("min_value"), F.lit(True))).alias("files_in_order"),
        F.bool_and("in_order").alias("in_order"),
        (F.max("n_rows") * F.count(F.lit(1)) <= 2 * F.sum("n_rows")).alias("balanced"),
    )
    values = runs.groupBy(F.col("value").alias("l_returnflag")).agg(F.sum("n_rows").alias("n_rows"))
    return values.withColumns({name: F.lit(fact) for name, fact in facts.first().asDict().items()})


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    """SELECT * FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT * FROM orders WHERE o_totalprice > 100000"""
)
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that meet both conditions appear twice."""
    orders = table(spark, folder, "orders")
    return orders.where("o_orderstatus = 'F'").union(orders.where("o_totalprice > 100000"))


@query(
    """SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0
       UNION SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 5000"""
)
def union_distinct(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    rich = customer.where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    poor = customer.where("c_acctbal < 5000").select("c_custkey", "c_mktsegment")
    return rich.union(poor).distinct()


@query(
    """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 5000
       UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal <= 5000"""
)
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    rich = customer.where("c_acctbal > 5000").select("c_custkey", "c_name", "c_acctbal")
    poor = customer.where("c_acctbal <= 5000").select("c_acctbal", "c_custkey", "c_name")
    return rich.unionByName(poor)


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", "l_shipdate").distinct()


@query("SELECT DISTINCT c_mktsegment FROM customer")
def distinct_column(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_mktsegment").distinct()
