"""Ranks of hot groups in two passes, against Spark's own windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import plan, same_rows

from millrace.operators import scans
from millrace.operators.scans import group_ranks
from millrace.operators.sizing import hot_keys


def skewed(spark, spread, rows=4000):
    """Most rows in one group, a null group, null values, and ties as wide as asked for."""
    ids = spark.range(rows).repartition(5)
    key = F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 < 9, F.concat(F.lit("k"), F.col("id") % 50))
    value = F.when(F.col("id") % 97 != 0, F.pmod(F.xxhash64("id"), F.lit(spread)))
    return ids.select("id", key.alias("key"), value.alias("value"))


def by_windows(df, order):
    group = Window.partitionBy("key")
    tied = group.orderBy(*order)
    single = group.orderBy(*order, "id").rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "*",
        F.row_number().over(group.orderBy(*order, "id")).cast("bigint").alias("row_number"),
        F.rank().over(tied).cast("bigint").alias("rank"),
        F.dense_rank().over(tied).cast("bigint").alias("dense_rank"),
        F.count(F.lit(1)).over(group).alias("group_rows"),
        F.sum("value").over(single).alias("total"),
    )


@pytest.mark.parametrize("spread", [1, 2, 7, 300, 10**9])
@pytest.mark.parametrize("order", ["value", "-value"])
def test_agrees_with_windows(spark, spread, order):
    df = skewed(spark, spread)
    wanted = by_windows(df, [F.col("value").desc() if order[0] == "-" else F.col("value")])
    got = group_ranks(df, ["key"], [order], row_key=["id"], running={"total": F.col("value")})
    same_rows(got, wanted)


def test_all_values_null(spark):
    df = skewed(spark, 5).withColumn("value", F.lit(None).cast("bigint"))
    got = group_ranks(df, ["key"], ["value"], row_key=["id"], running={"total": F.col("value")})
    same_rows(got, by_windows(df, [F.col("value")]))


def test_ranges_are_balanced(spark, monkeypatch):
    """No range of a hot group has much more than an even share, whatever the ties."""
    seen = []
    before = scans._before
    monkeypatch.setattr(scans, "_before", lambda ranked, *rest: seen.append(ranked) or before(ranked, *rest))
    df = skewed(spark, 2, 40_000)
    group_ranks(df, ["key"], ["value"], row_key=["id"])
    sizes = [r["count"] for r in seen[0].groupBy("_scan_slice").count().collect()]
    assert len(sizes) >= 4
    assert max(sizes) <= 1.5 * 40_000 / 8
    assert not {"hot"} - {r["key"] for r in seen[0].select("key").distinct().collect()}


def test_small_groups_take_one_window(spark):
    df = spark.range(2000).select("id", (F.col("id") % 400).alias("key"), F.col("id").alias("value"))
    assert not hot_keys(df, ["key"])
    result = group_ranks(df, ["key"], ["value"], row_key=["id"], running={"total": F.col("value")})
    assert "_of_slice" not in plan(result)
    same_rows(result, by_windows(df, [F.col("value")]))


def test_hot_keys_may_be_given(spark):
    df = skewed(spark, 50)
    cold = group_ranks(df, ["key"], ["value"], row_key=["id"], hot={})
    same_rows(group_ranks(df, ["key"], ["value"], row_key=["id"]), cold)


def test_names_are_checked(spark):
    with pytest.raises(ValueError, match="rank"):
        group_ranks(skewed(spark, 2).withColumn("rank", F.lit(1)), ["key"], ["value"], row_key=["id"])


def test_empty_table(spark):
    empty = skewed(spark, 2).limit(0)
    assert group_ranks(empty, ["key"], ["value"], row_key=["id"]).count() == 0
