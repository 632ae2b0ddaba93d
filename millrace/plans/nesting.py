"""JSON and arrays, over one nested record per order line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.scratch import fresh_path
from millrace.sources.files import read_json, table

ITEMS_DDL = "array<struct<amount double, item_id string, qty bigint>>"
_REST_DDL = f"customer_id string, order_id string, order_line_items {ITEMS_DDL}"
RECORD_DDL = f"contact array<bigint>, {_REST_DDL}"
TEXT_CONTACT_DDL = f"contact array<string>, {_REST_DDL}"
_FILE_BITS = 16  # rows per whole-file document: 2 ** 16


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    """A record per line with its goods and, if taxed, its tax as items.

    Lines with neither tax nor discount have no items. Nothing is grouped, so
    an array never holds more than two items, however many lines an order has.
    """
    return _records(table(spark, folder, "lineitem"))


def _records(lines: DataFrame, *kept: str) -> DataFrame:
    """A record per line, after the columns ``kept`` of the line itself."""
    goods = F.struct(
        F.col("l_extendedprice").alias("amount"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("qty"),
    )
    tax = F.struct(
        F.col("l_tax").alias("amount"),
        F.lit("tax").alias("item_id"),
        F.lit(1).cast("bigint").alias("qty"),
    )
    items = (
        F.when(F.col("l_tax") > 0, F.array(goods, tax))
        .when(F.col("l_discount") > 0, F.array(goods))
        .otherwise(F.array().cast(ITEMS_DDL))
    )
    return lines.select(
        *kept,
        F.array("l_suppkey", "l_partkey").alias("contact"),
        F.col("l_suppkey").cast("string").alias("customer_id"),
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("order_id"),
        items.alias("order_line_items"),
    )


def _flat(records: DataFrame) -> DataFrame:
    first = F.get("order_line_items", F.lit(0))
    return records.select(
        "order_id",
        "customer_id",
        F.get("contact", F.lit(0)).cast("bigint").alias("contact_1"),
        F.get("contact", F.lit(1)).cast("bigint").alias("contact_2"),
        F.size("order_line_items").alias("n_items"),
        first["item_id"].alias("first_item"),
        first["amount"].alias("first_amount"),
        first["qty"].alias("first_qty"),
    )


_ID_SQL = """CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
             CAST(l_suppkey AS VARCHAR) AS customer_id"""
_FLAT_SQL = f"""
    SELECT {_ID_SQL}, l_suppkey AS contact_1, l_partkey AS contact_2,
           CAST(CASE WHEN l_tax > 0 THEN 2 WHEN l_discount > 0 THEN 1 ELSE 0 END AS INTEGER)
               AS n_items,
           CASE WHEN l_tax > 0 OR l_discount > 0 THEN CAST(l_partkey AS VARCHAR) END AS first_item,
           CASE WHEN l_tax > 0 OR l_discount > 0 THEN l_extendedprice END AS first_amount,
           CASE WHEN l_tax > 0 OR l_discount > 0 THEN CAST(l_quantity AS BIGINT) END AS first_qty
    FROM lineitem"""
_ITEMS_SQL = f"""
    SELECT {_ID_SQL}, l_suppkey AS contact_1, l_partkey AS contact_2,
           CAST(l_partkey AS VARCHAR) AS item_id, l_extendedprice AS amount,
           CAST(l_quantity AS BIGINT) AS qty
    FROM lineitem WHERE l_tax > 0 OR l_discount > 0
    UNION ALL
    SELECT {_ID_SQL}, l_suppkey, l_partkey, 'tax', l_tax, CAST(1 AS BIGINT)
    FROM lineitem WHERE l_tax > 0"""


@query(_FLAT_SQL)
def json_lines_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "json-lines")
    order_records(spark, folder).write.json(path)
    return _flat(read_json(spark, path))


@query(_FLAT_SQL)
def json_multiline_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents spread over several lines, each file an array of bounded length.

    Each record is a row that knows whether a document begins or ends with it, and
    the writer puts a document's rows into its file one by one, in order. So a task
    that writes holds records, which it can spill, and no document.

    Numbers are read as numbers: to turn one into text Spark finds its place in
    the document again, which takes ever longer the longer the document.
    """
    path = fresh_path(spark, "json-documents")
    numbered = table(spark, folder, "lineitem").withColumn("_row", F.monotonically_increasing_id())
    placed = numbered.withColumn("_file", F.shiftright("_row", _FILE_BITS))
    in_file = Window.partitionBy("_file").orderBy("_row")
    placed = placed.withColumns(
        {
            "_before": F.when(F.lag("_row").over(in_file).isNull(), "[").otherwise(","),
            "_behind": F.when(F.lead("_row").over(in_file).isNull(), "]").otherwise(""),
        }
    )
    record = F.struct("contact", "customer_id", "order_id", "order_line_items")
    records = _records(placed, "_row", "_file", "_before", "_behind").select(
        "_row",
        "_file",
        F.concat("_before", F.to_json(record, {"pretty": "true"}), "_behind").alias("value"),
    )
    # A folder per document; the sort is there already, and says so to the writer.
    documents = records.sortWithinPartitions("_file", "_row").select("_file", "value")
    documents.write.partitionBy("_file").option("maxRecordsPerFile", 0).text(path)
    return _flat(read_json(spark, path, RECORD_DDL, multi_line=True))


@query(_FLAT_SQL)
def json_schema_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The schema makes texts of the contact numbers."""
    path = fresh_path(spark, "json-schema")
    order_records(spark, folder).write.json(path)
    return _flat(read_json(spark, path, TEXT_CONTACT_DDL))


@query(
    """SELECT '{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderpriority":"'
              || o_orderpriority || '"}' AS value FROM orders"""
)
def text_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "text")
    table(spark, folder, "orders").select("o_orderkey", "o_orderpriority").write.json(path)
    return spark.read.text(path)


@query(
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              CAST(NULL AS BIGINT) AS no_k FROM events"""
)
def json_parse(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id",
        F.from_json("props", "k bigint").alias("parsed"),
        F.from_json("event_type", "no_k bigint").alias("bad"),
    )
    return events.select("event_id", "parsed.*", "bad.*")


@query(
    """SELECT s_suppkey, '{"s_suppkey":' || CAST(s_suppkey AS VARCHAR) || ',"s_name":"' || s_name
              || '","s_nationkey":' || CAST(s_nationkey AS VARCHAR) || '}' AS supplier_json
       FROM supplier"""
)
def json_render(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.to_json(F.struct("s_suppkey", "s_name", "s_nationkey"))
    return table(spark, folder, "supplier").select("s_suppkey", whole.alias("supplier_json"))


def _exploded(records: DataFrame) -> DataFrame:
    items = records.withColumn("item", F.explode("order_line_items"))
    return items.select("contact", "customer_id", "order_id", "item.*")


@query(_ITEMS_SQL)
def explode_structs(spark: SparkSession, folder: str) -> DataFrame:
    """Records without items are dropped; ``explode_outer`` would keep them."""
    return _exploded(order_records(spark, folder)).select(
        "order_id",
        "customer_id",
        F.get("contact", F.lit(0)).alias("contact_1"),
        F.get("contact", F.lit(1)).alias("contact_2"),
        "item_id",
        "amount",
        "qty",
    )


@query(
    f"""SELECT order_id, customer_id, item_id, amount, qty, contact_1 AS contact
        FROM ({_ITEMS_SQL})
        UNION ALL
        SELECT order_id, customer_id, item_id, amount, qty, contact_2 FROM ({_ITEMS_SQL})"""
)
def explode_twice(spark: SparkSession, folder: str) -> DataFrame:
    items = _exploded(order_records(spark, folder))
    each = items.withColumn("one_contact", F.explode("contact")).drop("contact")
    return each.withColumnRenamed("one_contact", "contact").select(
        "order_id", "customer_id", "item_id", "amount", "qty", "contact"
    )
