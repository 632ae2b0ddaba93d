"""Salting, broadcasting and bucketing must not change what a join returns."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import plan, same_rows

from millrace.operators import joins, sizing
from millrace.operators.layout import partition_report
from millrace.operators.windows import window_max
from millrace.scratch import fresh_name


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third with key 7, a third null, a third unique; some equal rows."""
    key = F.when(F.col("id") < 1000, 7).when(F.col("id") < 2000, F.lit(None)).otherwise(F.col("id"))
    return spark.range(3000).select(key.cast("bigint").alias("k"), (F.col("id") % 10).alias("v"))


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(0, 2500).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("name"))


def plain(left, right, how, extra=None):
    on = F.col("k") == F.col("rk")
    return left.join(right, on if extra is None else on & extra, how)


def test_hot_keys_finds_value_and_null(skewed):
    hot = sizing.hot_keys(skewed, ["k"])
    hashes = skewed.where("k = 7 OR k IS NULL").select(sizing.key_hash(["k"])).distinct()
    assert hot == {r[0]: 4 for r in hashes.collect()}  # a third of 8 partitions


def test_even_keys_are_not_hot(spark):
    assert sizing.hot_keys(spark.range(1000), ["id"]) == {}


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "6000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_all_of_two_thousand_hot_keys_are_found(spark, many_partitions):
    """Each is three times an even partition; together they have all rows."""
    rows = spark.range(0, 120_000, 1, 8).select((F.col("id") % 2000).alias("k"))
    hot = sizing.hot_keys(rows, ["k"])
    assert len(hot) == 2000 and set(hot.values()) <= {4, 8}


def test_hot_keys_are_shared_out_to_several_sketches(spark, monkeypatch):
    monkeypatch.setattr(sizing, "_HOT_PER_SKETCH", 3)
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, F.col("id") % 3).otherwise(F.col("id")).alias("k"))
    assert len(sizing.hot_keys(rows, ["k"])) == 3


def test_joins_measure_each_side_once(skewed, keys, monkeypatch):
    calls = []
    monkeypatch.setattr(joins, "measure", lambda df, *a, **k: calls.append("right") or sizing.measure(df, *a, **k))
    monkeypatch.setattr(joins, "hot_keys", lambda df, *a: calls.append("left") or sizing.hot_keys(df, *a))
    joins.keyed_join(skewed, keys, ["k"], ["rk"], limit=10)
    assert calls == ["right", "left"]
    calls.clear()
    joins.hash_join(skewed, keys, ["k"], ["rk"])
    assert calls == ["right", "left"]
    calls.clear()
    joins.keyed_join(skewed, keys, ["k"], ["rk"])
    assert calls == ["right"]


def test_shuffled_rows_need_a_row_key(skewed, keys):
    shuffled = skewed.repartition(3)
    with pytest.raises(ValueError, match="row_key"):
        joins.salted_join(shuffled, keys, ["k"], ["rk"])
    with pytest.raises(ValueError, match="row_key"):
        joins.keyed_join(shuffled, keys, ["k"], ["rk"], limit=10)
    named = shuffled.withColumn("n", F.col("v"))
    joins.keyed_join(named, keys, ["k"], ["rk"], limit=10, row_key=["n"])


def test_hot_keys_of_empty_table(skewed):
    assert sizing.hot_keys(skewed.where("v < 0"), ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("only_hot", [True, False])
def test_salted_join_equals_plain(skewed, keys, how, only_hot):
    hot = sizing.hot_keys(skewed, ["k"]) if only_hot else None
    salted = joins.salted_join(skewed, keys, ["k"], ["rk"], how, hot=hot, salts=5)
    same_rows(salted, plain(skewed, keys, how))


def test_salted_join_with_residual(skewed, keys):
    extra = F.col("v") < 3
    salted = joins.salted_join(skewed, keys, ["k"], ["rk"], "left", residual=extra)
    same_rows(salted, plain(skewed, keys, "left", extra))


def test_row_key_salt(skewed, keys):
    numbered = skewed.withColumn("n", F.monotonically_increasing_id())
    salted = joins.salted_join(numbered, keys, ["k"], ["rk"], "left", row_key=["n"])
    same_rows(salted.drop("n"), plain(skewed, keys, "left"))


def test_salts_spread_even_equal_rows(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"))
    sizes = joins.add_salt(rows, ["k"], salts=4).groupBy(joins.SALT).count().collect()
    assert sorted(r["_salt"] for r in sizes) == [0, 1, 2, 3]
    assert max(r["count"] for r in sizes) <= 320


def test_salts_do_not_follow_a_pattern_in_the_keys(spark):
    """Hot rows at every fourth position still meet all four salts."""
    rows = spark.range(0, 4000, 1, 2).select(F.when(F.col("id") % 4 == 0, 1).otherwise(0).alias("k"))
    hot = {rows.where("k = 1").select(sizing.key_hash(["k"])).first()[0]: 4}
    salted = joins.add_salt(rows, ["k"], hot=hot)
    sizes = {r[joins.SALT]: r["count"] for r in salted.where("k = 1").groupBy(joins.SALT).count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3] and max(sizes.values()) < 320
    assert salted.where(f"k = 0 AND {joins.SALT} <> 0").count() == 0


def test_keyed_join_plans(spark, skewed, keys):
    assert "_salt" not in plan(joins.keyed_join(skewed, keys, ["k"], ["rk"], hint="merge", hot={}))
    hot = sizing.hot_keys(skewed, ["k"])
    salted = joins.keyed_join(skewed, keys, ["k"], ["rk"], hint="merge", hot=hot)
    assert "SortMergeJoin" in plan(salted)
    assert "_salt" in plan(salted)
    small = joins.keyed_join(skewed, keys, ["k"], ["rk"], hot=hot)
    assert "BroadcastHashJoin" in plan(small) and "_salt" not in plan(small)
    large = joins.keyed_join(skewed, keys, ["k"], ["rk"], hot=hot, limit=10)
    assert "SortMergeJoin" in plan(large) and "_salt" in plan(large)
    same_rows(small, salted)


def test_hot_key_is_spread_over_tasks(spark):
    """A third of the rows has one key; no task may get much more than its share."""
    left = spark.range(48_000).select(
        F.when(F.col("id") < 16_000, 1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    )
    right = spark.range(48_000).select(F.col("id").alias("rk"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {}
        for name, hot in (("plain", {}), ("salted", sizing.hot_keys(left, ["k"]))):
            joined = joins.merge_join(left, right, ["k"], ["rk"], hot=hot)
            sizes[name] = max(r["n_rows"] for r in partition_report(joined).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes["plain"] > 16_000
    assert sizes["salted"] < 13_000


def test_broadcast_only_below_limit(skewed, keys):
    small = joins.keyed_join(skewed, keys, ["k"], ["rk"], "left")
    assert "BroadcastHashJoin" in plan(small)
    spark = skewed.sparkSession
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.keyed_join(skewed, keys, ["k"], ["rk"], "left", limit=10, hot={})
        assert "BroadcastHashJoin" not in plan(large)
        same_rows(large, small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hash_join_falls_back(skewed, keys):
    assert "ShuffledHashJoin" in plan(joins.hash_join(skewed, keys, ["k"], ["rk"]))
    assert "ShuffledHashJoin" not in plan(joins.hash_join(skewed, keys, ["k"], ["rk"], limit=10))


def test_parts_follow_the_share(spark):
    df = spark.range(800).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 2).alias("k"))
    parts = sizing.hot_keys(df, ["k"])
    assert list(parts.values()) == [8]
    copies = joins.add_all_salts(df.select("k").distinct(), ["k"], hot=parts).groupBy("k").count()
    assert {r["k"]: r["count"] for r in copies.collect()} == {0: 1, 1: 8}


def test_data_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n bigint")
    assert sizing.data_bytes(df) == 2 * (16 + 16) + 3
    assert sizing.data_bytes(df.where("n > 5")) == 0
    assert sizing.fits_in(df, 67) and not sizing.fits_in(df, 66) and not sizing.fits_in(df, 31)


@pytest.mark.parametrize("measured", [True, False])
def test_bucketed_join_does_not_shuffle(spark, tmp_path, skewed, keys, measured):
    hot = sizing.hot_keys(skewed, ["k"]) if measured else {}
    assert bool(hot) == measured
    names = (fresh_name("left_side"), fresh_name("right_side"))
    paths = (str(tmp_path / "l"), str(tmp_path / "r"))
    joins.bucketed_pair(skewed, keys, ["k"], ["rk"], names, paths, 4, hot=hot)
    joined = joins.bucketed_join(spark, names, ["k"], ["rk"])
    assert "Exchange" not in plan(joined)
    same_rows(joined, plain(skewed, keys, "left"))
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_bad_calls(skewed, keys, spark):
    with pytest.raises(ValueError, match="join type"):
        joins.keyed_join(skewed, keys, ["k"], ["rk"], "full")
    with pytest.raises(ValueError, match="both sides"):
        joins.keyed_join(skewed, skewed, ["k"], ["k"])
    narrow = keys.withColumn("rk", F.col("rk").cast("int"))
    with pytest.raises(ValueError, match="one type"):
        joins.keyed_join(skewed, narrow, ["k"], ["rk"])
    floats = skewed.withColumn("k", F.col("k").cast("double"))
    with pytest.raises(ValueError, match="floating"):
        joins.keyed_join(floats, keys.withColumn("rk", F.col("rk").cast("double")), ["k"], ["rk"])


@pytest.mark.parametrize("hot", [None, {}])
def test_window_max_joins_maxima_back(skewed, hot):
    by_join = window_max(skewed, ["k"], "v", "top", hot=hot)
    assert "Window" not in plan(by_join)
    same_rows(by_join, skewed.withColumn("top", F.max("v").over(Window.partitionBy("k"))))
