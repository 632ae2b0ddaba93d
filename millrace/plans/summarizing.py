"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.exact import binned_sums, exact, exact_avg, exact_sum
from millrace.operators import aggregates
from millrace.plans.projecting import with_status
from millrace.plans.registry import query
from millrace.sources.files import table


@query(
    """SELECT o_orderpriority, COUNT(CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 END) AS n_status
       FROM orders GROUP BY o_orderpriority"""
)
def agg_count(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls are not counted."""
    orders = with_status(table(spark, folder, "orders"))
    return orders.groupBy("o_orderpriority").agg(F.count("status").alias("n_status"))


@query("SELECT c_mktsegment, COUNT(*) AS n_customers FROM customer GROUP BY c_mktsegment")
def agg_count_star(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "customer").groupBy("c_mktsegment").count()
    return counts.withColumnRenamed("count", "n_customers")


@query(
    """SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM lineitem GROUP BY l_suppkey"""
)
def agg_sum(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.groupBy("l_suppkey").agg(exact_sum("l_extendedprice").alias("total"))


_AVG_SQL = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice)"


@query(f"SELECT o_orderpriority, {_AVG_SQL} AS avg_price FROM orders GROUP BY o_orderpriority")
def agg_avg(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.groupBy("o_orderpriority").agg(exact_avg("o_totalprice").alias("avg_price"))


@query(
    """WITH charged AS (SELECT l_suppkey, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
                        FROM lineitem),
            summed AS (SELECT l_suppkey, COUNT(charge) AS n_charges,
                              CAST(CAST(SUM(CAST(charge * 4503599627370496 AS HUGEINT)) AS VARCHAR) AS DOUBLE)
                              / 4503599627370496 AS total
                       FROM charged GROUP BY l_suppkey)
       SELECT l_suppkey, total, n_charges, total / n_charges AS mean FROM summed"""
)
def agg_sum_any(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of products, which have as many decimals as a double can hold."""
    lines = table(spark, folder, "lineitem")
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    charged = lines.select("l_suppkey", charge.alias("charge"))
    sums = binned_sums(charged, ["l_suppkey"], "charge", "total", "n_charges")
    return sums.withColumn("mean", F.col("total") / F.col("n_charges"))


@query(
    f"""SELECT o_custkey, {_AVG_SQL} AS avg_price FROM orders
        GROUP BY o_custkey HAVING {_AVG_SQL} > 250000"""
)
def agg_having(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    averages = orders.groupBy("o_custkey").agg(exact_avg("o_totalprice").alias("avg_price"))
    return averages.where("avg_price > 250000")


@query(
    """SELECT l_suppkey, CAST(trunc(SUM(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS total
       FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey"""
)
def agg_filtered_sum(spark: SparkSession, folder: str) -> DataFrame:
    """The sum loses its fraction."""
    lines = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    total = F.sum(exact("l_extendedprice")).cast("bigint")
    return lines.groupBy("l_suppkey").agg(total.alias("total"))


@query(
    """SELECT CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)
                   AS DOUBLE) AS returned_total,
              COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned
       FROM lineitem"""
)
def agg_conditional(spark: SparkSession, folder: str) -> DataFrame:
    """What a shared counter would add up row by row."""
    price = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
    return table(spark, folder, "lineitem").agg(
        exact_sum(price).alias("returned_total"), F.count(price).alias("n_returned")
    )


@query(
    """SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order,
              MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price
       FROM orders GROUP BY o_custkey"""
)
def agg_min_max(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.min("o_totalprice").alias("min_price"),
        F.max("o_totalprice").alias("max_price"),
    )


@query("SELECT p_brand, COUNT(*) AS n_parts FROM part GROUP BY p_brand ORDER BY n_parts DESC, p_brand")
def value_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.value_frequency(table(spark, folder, "part"), "p_brand", "n_parts")


@query(
    """SELECT kind, COUNT(*) AS n_rows, COUNT(*) / CAST((SELECT COUNT(*) FROM events) AS DOUBLE)
              AS share
       FROM (SELECT CASE WHEN event_type = 'click' THEN 'click' ELSE 'other' END AS kind
             FROM events) GROUP BY kind"""
)
def key_skew(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "click").otherwise("other")
    return aggregates.key_skew(table(spark, folder, "events").select(kind.alias("kind")), "kind")


@query(
    r"""SELECT word, COUNT(*) AS n
        FROM (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word"""
)
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.word_count(table(spark, folder, "documents"), "text")


_LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS col_name, '{kind}' AS data_type, COUNT({name}) AS n_values FROM lineitem"
        for name, kind in _LINEITEM_TYPES.items()
    )
)
def describe_table(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.column_profile(table(spark, folder, "lineitem"))
