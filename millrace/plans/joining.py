"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.exact import exact, exact_sum
from millrace.operators.filtered import band_join, filtered_join
from millrace.operators.joins import (
    add_all_salts,
    bucketed_join as join_buckets,
    bucketed_pair,
    hash_join,
    keyed_join,
    merge_join,
)
from millrace.operators.relations import sql_over
from millrace.operators.sizing import BROADCAST_LIMIT_BYTES, fits_in
from millrace.operators.udfs import lookup
from millrace.plans.projecting import with_status
from millrace.plans.registry import query
from millrace.scratch import fresh_name, fresh_path
from millrace.sources.files import table

_STATUS_IS_NULL = "o_orderstatus NOT IN ('F', 'O')"


@query(
    """SELECT n_name, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
              COUNT(*) AS n_orders
       FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       GROUP BY n_name"""
)
def revenue_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """Orders are summed per customer first, so no join sees a repeated key."""
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.sum(exact("o_totalprice")).alias("spent"), F.count(F.lit(1)).alias("n"))
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("spent").alias("spent"), F.sum("n").alias("n_orders"))
    )
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = keyed_join(
        per_nation, nation, ["c_nationkey"], ["n_nationkey"], row_key=["c_nationkey"]
    )
    return named.select("n_name", F.col("spent").cast("double").alias("revenue"), "n_orders")


@query(
    """SELECT o_orderkey, c_custkey, c_name, o_totalprice
       FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    joined = keyed_join(orders, customer, ["o_custkey"], ["c_custkey"])
    return joined.select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query(
    """SELECT o_orderkey, o_custkey, c_custkey, c_name
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0)
       ON o_custkey = c_custkey"""
)
def join_left(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").where("c_acctbal > 0").select("c_custkey", "c_name")
    return keyed_join(orders, customer, ["o_custkey"], ["c_custkey"], "left")


@query(
    f"""SELECT o_orderkey, c_custkey, c_nationkey
        FROM orders LEFT JOIN customer
        ON o_custkey = c_custkey AND (c_nationkey = 1 OR c_nationkey = 2) AND {_STATUS_IS_NULL}"""
)
def join_compound(spark: SparkSession, folder: str) -> DataFrame:
    """The further conditions decide about matches, not about rows of the left side."""
    orders = with_status(table(spark, folder, "orders")).select("o_orderkey", "o_custkey", "status")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    also = ((F.col("c_nationkey") == 1) | (F.col("c_nationkey") == 2)) & F.col("status").isNull()
    joined = keyed_join(orders, customer, ["o_custkey"], ["c_custkey"], "left", residual=also)
    return joined.select("o_orderkey", "c_custkey", "c_nationkey")


def _lines_using_order(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity"
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderpriority"
    )
    right = orders.withColumnRenamed("orderkey", "_orderkey")
    return keyed_join(lines, right, ["orderkey"], ["_orderkey"]).drop("_orderkey")


@query(
    """SELECT orderkey, l_linenumber, l_quantity, o_orderpriority
       FROM (SELECT l_orderkey AS orderkey, l_linenumber, l_quantity FROM lineitem)
       JOIN (SELECT o_orderkey AS orderkey, o_orderpriority FROM orders) USING (orderkey)"""
)
def join_using(spark: SparkSession, folder: str) -> DataFrame:
    """A key of one name on both sides appears once."""
    return _lines_using_order(spark, folder)


@query(
    """SELECT CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def agg_global(spark: SparkSession, folder: str) -> DataFrame:
    joined = _lines_using_order(spark, folder)
    return joined.agg(exact_sum("l_quantity").alias("total_quantity"))


@query(
    """WITH totals AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
                              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
                       FROM orders GROUP BY 1, 2)
       SELECT a.o_custkey, a.order_year, a.spent, b.spent AS spent_before
       FROM totals a JOIN totals b
       ON a.o_custkey = b.o_custkey AND a.order_year = b.order_year + 1"""
)
def join_self(spark: SparkSession, folder: str) -> DataFrame:
    """A year's orders of a customer beside those of the year before.

    Customer and year identify a row, so each row meets at most one other.
    """
    totals = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("order_year"))
        .agg(exact_sum("o_totalprice").alias("spent"))
    )
    now, before = totals.alias("a"), totals.alias("b")
    follows = (F.col("a.o_custkey") == F.col("b.o_custkey")) & (
        F.col("a.order_year") == F.col("b.order_year") + 1
    )
    return now.join(before, follows).select(
        "a.o_custkey", "a.order_year", "a.spent", F.col("b.spent").alias("spent_before")
    )


@query(
    """SELECT s_suppkey, s_name, CAST(copy AS INTEGER) AS copy
       FROM supplier CROSS JOIN (SELECT unnest(range(0, 4)) AS copy)"""
)
def join_cross(spark: SparkSession, folder: str) -> DataFrame:
    """Each row once per salt, as the salted join needs it, without a cross join."""
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return add_all_salts(supplier, ["s_suppkey"], salts=4, name="copy")


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, s_suppkey, s_name
       FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey"""
)
def join_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return keyed_join(lines, supplier, ["l_suppkey"], ["s_suppkey"], "left")


@query("SELECT c.*, n_name FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey")
def join_broadcast_sql(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    hint = "/*+ BROADCAST(n) */" if fits_in(nation, BROADCAST_LIMIT_BYTES) else ""
    customers, nations = fresh_name("customer"), fresh_name("nation")
    return sql_over(
        spark,
        f"""SELECT {hint} c.*, n.n_name
            FROM {customers} c LEFT OUTER JOIN {nations} n
            ON c.c_nationkey = n.n_nationkey""",
        **{customers: table(spark, folder, "customer"), nations: nation},
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderkey, o_orderdate
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""
)
def join_merge(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return merge_join(lines, orders, ["l_orderkey"], ["o_orderkey"], "left")


def skewed_events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events of two kinds, most of them one, and a table with a row for that one."""
    kind = F.when(F.col("event_type") == "click", "click").otherwise("other")
    events = table(spark, folder, "events").select("event_id", "value", kind.alias("kind"))
    kinds = events.where("kind <> 'click'").groupBy(F.col("kind").alias("kind_key"))
    return events, kinds.agg(F.max("value").alias("top_value"))


_KINDS_SQL = """
    WITH e AS (SELECT event_id, value, CASE WHEN event_type = 'click' THEN 'click'
                                            ELSE 'other' END AS kind FROM events),
         k AS (SELECT kind AS kind_key, max(value) AS top_value FROM e
               WHERE kind <> 'click' GROUP BY kind)
    SELECT event_id, value, kind, kind_key, top_value FROM e LEFT JOIN k ON kind = kind_key"""


@query(_KINDS_SQL)
def join_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The hot kind is found by measuring, and salted."""
    events, kinds = skewed_events(spark, folder)
    return merge_join(events, kinds, ["kind"], ["kind_key"], "left", row_key=["event_id"])


@query(_KINDS_SQL)
def bucketed_join(spark: SparkSession, folder: str) -> DataFrame:
    """The joined frame knows its files, so the tables leave the catalog at once."""
    events, kinds = skewed_events(spark, folder)
    names = (fresh_name("events"), fresh_name("kinds"))
    paths = (fresh_path(spark, "bucketed-events"), fresh_path(spark, "bucketed-kinds"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed_pair(events, kinds, ["kind"], ["kind_key"], names, paths, buckets, row_key=["event_id"])
    joined = join_buckets(spark, names, ["kind"], ["kind_key"])
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return joined


@query(_KINDS_SQL)
def join_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """No hints: adaptive execution divides the large partitions of the left side."""
    events, kinds = skewed_events(spark, folder)
    return events.join(kinds, events.kind == kinds.kind_key, "left")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, p_partkey, p_brand
       FROM lineitem JOIN part ON l_partkey = p_partkey"""
)
def join_shuffle_hash(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    return hash_join(lines, part, ["l_partkey"], ["p_partkey"])


@query(
    """SELECT c_custkey, c_nationkey, n_name
       FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0)
       ON c_nationkey = n_nationkey"""
)
def dict_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    names = table(spark, folder, "nation").where("n_regionkey <> 0").select("n_nationkey", "n_name")
    return lookup(customer, "c_nationkey", names, "n_nationkey")


LINE_KEY = ("l_orderkey", "l_linenumber")


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderkey, o_totalprice
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_totalprice > 400000"""
)
def join_bloom(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the dearest orders; other lines are left out before the shuffle."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, folder, "orders").where("o_totalprice > 400000").select("o_orderkey", "o_totalprice")
    return filtered_join(lines, orders, ["l_orderkey"], ["o_orderkey"], row_key=LINE_KEY, limit=0)


@query(
    """SELECT l_orderkey, l_linenumber, o_orderkey, o_totalprice FROM lineitem
       LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON l_orderkey = o_orderkey"""
)
def join_bloom_left(spark: SparkSession, folder: str) -> DataFrame:
    """All lines, with the order if it is one of the dearest."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    orders = table(spark, folder, "orders").where("o_totalprice > 400000").select("o_orderkey", "o_totalprice")
    return filtered_join(lines, orders, ["l_orderkey"], ["o_orderkey"], "left", row_key=LINE_KEY, limit=0)


@query(
    """SELECT a.o_custkey AS custkey, a.o_orderkey AS orderkey, b.o_orderkey AS later_orderkey,
              CAST(date_diff('day', CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE)) AS INTEGER) AS days
       FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey
       WHERE date_diff('day', CAST(a.o_orderdate AS DATE), CAST(b.o_orderdate AS DATE)) BETWEEN 1 AND 30"""
)
def join_band(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of a customer with those that followed within 30 days."""
    orders = table(spark, folder, "orders")
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    one = orders.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), day.alias("day"))
    other = orders.select(
        F.col("o_custkey").alias("later_custkey"),
        F.col("o_orderkey").alias("later_orderkey"),
        day.alias("later_day"),
    )
    pairs = band_join(one, other, ["custkey"], ["later_custkey"], "day", "later_day", 30)
    return pairs.select("custkey", "orderkey", "later_orderkey", (F.col("later_day") - F.col("day")).alias("days"))
