"""Partitioning, clustering, caching, reports."""

import gc

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F
from rows import plan, same_rows

import __spark_entry__ as entry_point
from millrace.functions.exact import exact_avg, exact_sum
from millrace.operators import aggregates, caching, layout
from millrace.operators.sizing import quantiles
from millrace.operators.windows import nth_in_group
from millrace.sources.files import table


def touched(report, low, high):
    return report.where((F.col("min_value") <= high) & (F.col("max_value") >= low)).count()


def test_zorder_lets_readers_skip_files(spark, folder, tmp_path):
    lines = table(spark, folder, "lineitem")
    path = str(tmp_path / "z")
    layout.zorder_rewrite(lines, ["l_partkey", "l_suppkey"], path, files=16)
    clustered = spark.read.parquet(path)
    same_rows(clustered, lines)
    for column, low, high in (("l_partkey", 100, 110), ("l_suppkey", 3, 4)):
        report = layout.file_min_max(clustered, column)
        assert report.count() == 16
        assert touched(report, low, high) <= 8


def test_zorder_of_one_partition(spark, folder, tmp_path):
    lines = table(spark, folder, "lineitem")
    path = str(tmp_path / "z")
    layout.zorder_rewrite(
        lines, ["l_shipdate"], path,
        where=F.col("l_returnflag") == "R", partition_by=["l_returnflag"], files=4,
    )
    stored = spark.read.schema(lines.schema).parquet(path)
    same_rows(stored.select(lines.columns), lines.where("l_returnflag = 'R'"))


def test_zorder_divides_equal_rows(spark, tmp_path):
    equal = spark.range(40_000).select(F.lit(1).alias("a"), F.lit("x").alias("b"))
    path = str(tmp_path / "z")
    layout.zorder_rewrite(equal, ["a"], path, files=4)
    sizes = [r["n_rows"] for r in layout.file_min_max(spark.read.parquet(path), "a").collect()]
    assert len(sizes) == 4 and max(sizes) < 15_000


def test_zorder_of_dates_and_nulls(spark, tmp_path):
    df = spark.range(100).select(
        F.expr("CASE WHEN id % 3 > 0 THEN date_add(DATE '2020-01-01', CAST(id AS INT)) END").alias("d"),
        F.col("id").cast("decimal(10,2)").alias("n"),
    )
    layout.zorder_rewrite(df, ["d", "n"], str(tmp_path / "z"))
    same_rows(spark.read.parquet(str(tmp_path / "z")), df)


def test_zorder_of_nulls_only_and_of_text(spark, tmp_path):
    df = spark.range(10).select(F.lit(None).cast("double").alias("a"), F.lit("x").alias("b"))
    layout.zorder_rewrite(df, ["a"], str(tmp_path / "z"))
    same_rows(spark.read.parquet(str(tmp_path / "z")), df)
    layout.zorder_rewrite(df, ["b", "a"], str(tmp_path / "y"))
    same_rows(spark.read.parquet(str(tmp_path / "y")), df)
    with pytest.raises(ValueError, match="cluster by t"):
        layout.with_zorder(df.select(F.array("b").alias("t")), ["t"], "z", 6)


def test_zorder_on_text_lets_readers_skip_files(spark, folder, tmp_path):
    part = table(spark, folder, "part")
    path = str(tmp_path / "z")
    layout.zorder_rewrite(part, ["p_name", "p_size"], path, files=16)
    clustered = spark.read.parquet(path)
    same_rows(clustered, part)
    report = layout.file_min_max(clustered, "p_name")
    name = part.agg(F.max("p_name")).first()[0]
    assert report.count() == 16
    assert report.where((F.col("min_value") <= name) & (F.col("max_value") >= name)).count() <= 8


def test_zorder_bits_follow_files_and_columns():
    assert layout.zorder_bits(8, 2) == layout.LEAST_BITS
    assert layout.zorder_bits(50_000, 2) == 11
    assert layout.zorder_bits(50_000, 1) == layout.MOST_BITS


def test_quantiles_over_many_partitions(spark):
    df = spark.range(0, 10_000, 1, 40).select(F.col("id").cast("double").alias("x"))
    found = quantiles(df, ["x"], 4)["x"]
    assert all(abs(got - want) < 200 for got, want in zip(found, (2500, 5000, 7500), strict=True))
    assert quantiles(df.where("x < 0"), ["x"], 4) == {"x": []}


def test_spread_by_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 1).otherwise(F.col("id")).alias("k"))
    spread = layout.spread_by_key(df, ["k"], 8)
    same_rows(spread, df)
    sizes = [r["n_rows"] for r in layout.partition_report(spread).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 7_000
    together = layout.spread_by_key(df, ["k"], 8, hot={})
    assert max(r["n_rows"] for r in layout.partition_report(together).collect()) >= 15_000


def test_one_partition_can_be_picked(spark):
    placed = spark.range(0, 100, 1, 4).withColumn("partition_id", F.spark_partition_id())
    assert placed.where("partition_id = 0").count() == 25


def test_derived_frames_use_the_cache_until_it_is_released(spark, folder):
    lines = table(spark, folder, "lineitem").where("l_quantity > 45")
    kept = caching.cached(lines, StorageLevel.MEMORY_ONLY_2)
    derived = kept.groupBy("l_returnflag").count().select("count")
    gc.collect()
    assert "InMemoryTableScan" in plan(derived)
    same_rows(derived, lines.groupBy("l_returnflag").count().select("count"))
    kept.unpersist()
    with caching.held(lines) as kept:
        assert kept.is_cached
    assert not kept.is_cached


def test_cached_reuse_stays_cached_for_derived_frames(spark, folder):
    derived = entry_point.queries()["cached_reuse"](spark, folder).select("value", "total")
    gc.collect()
    assert "InMemoryTableScan" in plan(derived)
    spark.catalog.clearCache()


def test_nth_keeps_few_rows_before_the_shuffle(spark, folder):
    orders = table(spark, folder, "orders")
    second = nth_in_group(orders, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"], 2)
    text = plan(second)
    assert text.count("WindowGroupLimit") >= 2
    assert "Partial" in text


def test_observed_total_equals_aggregate(spark, folder):
    lines = table(spark, folder, "lineitem")
    flag, price = F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")
    watched, seen = aggregates.observed_total(lines, flag, price)
    watched.write.format("noop").mode("overwrite").save()
    expected = lines.where(flag).agg(F.sum(price)).first()[0]
    assert seen.get == {"total": expected, "rows": lines.count()}


def test_column_profile_counts_values(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a b` int, s string")
    rows = [tuple(r) for r in aggregates.column_profile(df).collect()]
    assert rows == [("a b", "int", 2), ("s", "string", 1)]


def test_value_frequency_is_ordered(spark, folder):
    counts = [
        (-r["n_rows"], r["p_brand"])
        for r in aggregates.value_frequency(table(spark, folder, "part"), "p_brand").collect()
    ]
    assert counts == sorted(counts)


def test_reports_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert aggregates.key_skew(empty, "k").count() == 0
    assert aggregates.value_frequency(empty, "k").count() == 0
    assert aggregates.rows_and_values(empty, ["v"]).first().asDict() == {"n_rows": 0, "n_v": 0}


def test_exact_sums_keep_all_digits(spark):
    fine = spark.createDataFrame([(0.125,), (0.25,), (None,)], "x double")
    assert fine.agg(exact_sum("x", 3), exact_avg("x", 3)).first() == (0.375, 0.1875)
    for bad in (fine, spark.createDataFrame([(1e27,)], "x double")):
        with pytest.raises(Exception, match="decimals"):
            bad.agg(exact_sum("x")).collect()
