"""Joins behind a Bloom filter, and joins within a band."""

import random

import pytest
from pyspark.sql import functions as F
from rows import plan, same_rows

from millrace.operators import filtered
from millrace.operators.filtered import band_join, filter_bits, filtered_join, key_filter, may_match


def sides(spark):
    """A left side of which a third has one key and some have none; few keys are on the right."""
    ids = spark.range(30_000).repartition(4)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 0, F.col("id") % 5000)
    left = ids.select("id", key.cast("bigint").alias("k"))
    right = spark.range(40).select((F.col("id") * 7).alias("k2"), F.concat(F.lit("v"), "id").alias("v"))
    return left, right.union(spark.createDataFrame([(None, "none"), (7, "again")], "k2 bigint, v string"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_agrees_with_a_plain_join(spark, how):
    left, right = sides(spark)
    result = filtered_join(left, right, ["k"], ["k2"], how, row_key=["id"], limit=0)
    same_rows(result, left.join(right, F.col("k") == F.col("k2"), how))
    assert "getbit" in plan(result)
    residual = F.col("id") % 2 == 0
    result = filtered_join(left, right, ["k"], ["k2"], how, row_key=["id"], limit=0, residual=residual)
    same_rows(result, left.join(right, (F.col("k") == F.col("k2")) & residual, how))


def test_few_rows_without_a_partner_pass(spark):
    left, right = sides(spark)
    for rows in (right, spark.range(3000).select((F.col("id") * 97).alias("k2"))):
        bits = filter_bits(rows.count())
        kept = spark.range(200_000).select(F.col("id").alias("k")).where(may_match(["k"], key_filter(rows, ["k2"], bits), bits))
        keys = rows.select("k2").dropna().distinct()
        alone = kept.join(keys, F.col("k") == F.col("k2"), "left_anti").count()
        assert kept.join(keys, F.col("k") == F.col("k2"), "left_semi").count() == keys.where("k2 < 200000").count()
        assert alone <= 0.01 * 200_000


def test_several_keys_and_empty_sides(spark):
    left = spark.range(500).select("id", (F.col("id") % 9).alias("a"), F.concat(F.lit("t"), F.col("id") % 5).alias("b"))
    right = spark.createDataFrame([(3, "t1"), (4, "t0"), (3, "zz"), (None, "t1")], "a2 bigint, b2 string")
    matched = (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))
    for how in ("inner", "left"):
        got = filtered_join(left, right, ["a", "b"], ["a2", "b2"], how, row_key=["id"], limit=0)
        same_rows(got, left.join(right, matched, how))
        none = filtered_join(left, right.limit(0), ["a", "b"], ["a2", "b2"], how, row_key=["id"], limit=-1)
        assert none.count() == (500 if how == "left" else 0)
    assert filtered_join(left.limit(0), right, ["a", "b"], ["a2", "b2"], row_key=["id"], limit=0).count() == 0


def test_no_filter_where_it_does_not_pay(spark, monkeypatch):
    left, right = sides(spark)
    assert "getbit" not in plan(filtered_join(left, right, ["k"], ["k2"], row_key=["id"]))  # broadcast
    monkeypatch.setattr(filtered, "MOST_BITS", 512)
    result = filtered_join(left, right, ["k"], ["k2"], row_key=["id"], limit=0)
    assert "getbit" not in plan(result)
    same_rows(result, left.join(right, F.col("k") == F.col("k2")))


@pytest.mark.parametrize("width", [1, 5, 64])
def test_band_agrees_with_a_plain_join(spark, width):
    chance = random.Random(width)
    rows = [
        (i, chance.choice(["hot", "hot", "a", "b", None]), chance.choice([None, *range(-150, 150)])) for i in range(900)
    ]
    left = spark.createDataFrame(rows, "id int, k string, at int")
    right = left.toDF("id2", "k2", "at2")
    apart = F.col("at2") - F.col("at")
    wanted = left.join(right, (F.col("k") == F.col("k2")) & (apart > 0) & (apart <= width))
    got = band_join(left, right, ["k"], ["k2"], "at", "at2", width, row_key=["id"])
    same_rows(got, wanted)
    assert got.count() > 0


def test_band_of_hot_bins_is_salted(spark):
    left = spark.range(8000).select("id", F.lit("hot").alias("k"), (F.col("id") % 3).alias("at"))
    right = spark.createDataFrame([("hot", 2), ("hot", 1), ("cold", 1)], "k2 string, at2 bigint")
    result = band_join(left, right, ["k"], ["k2"], "at", "at2", 1, row_key=["id"])
    assert "_salt" in plan(result)
    assert result.count() == sum((at2 - i % 3) == 1 for i in range(8000) for at2 in (2, 1))
    with pytest.raises(ValueError, match="width"):
        band_join(left, right, ["k"], ["k2"], "at", "at2", 0)
