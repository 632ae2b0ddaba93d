"""Sums of doubles: independent of order, and right."""

import math
import random

import pytest
from pyspark.errors import PySparkException

from millrace.functions.exact import binned_sums, exact_avg, exact_sum


def sums(spark, rows, partitions=4, **more):
    df = spark.createDataFrame(rows, "k int, x double").repartition(partitions)
    return {r["k"]: (r["s"], r["n"]) for r in binned_sums(df, ["k"], "x", "s", "n").collect()}


def draw(chance, kind):
    if kind == "money":
        return round(chance.uniform(-1e5, 1e5), 2)
    if kind == "wide":
        return chance.choice([-1, 1]) * chance.random() * 10.0 ** chance.randint(-300, 290)
    if kind == "tiny":
        return chance.choice([5e-324, 2.0**-1060, 3e-310, -1e-308, 2.0**-800, -(2.0**-799)]) * chance.randint(1, 9)
    if kind == "powers":
        return chance.choice([-1, 1]) * 2.0 ** chance.randint(-1074, 1000)
    return chance.gauss(0, 1)


@pytest.mark.parametrize("kind", ["money", "plain", "wide", "tiny", "powers"])
def test_sums_are_right_and_independent_of_order(spark, kind):
    chance = random.Random(kind)
    rows = [(k, draw(chance, kind)) for k in range(30) for _ in range(chance.randint(1, 90))]
    found = sums(spark, rows)
    for k in range(30):
        values = [x for key, x in rows if key == k]
        assert found[k] == (math.fsum(values), len(values))
    chance.shuffle(rows)
    assert sums(spark, rows, 7) == found


def test_cancelling(spark):
    assert sums(spark, [(1, x) for x in (1e100, 1.0, -1e100)]) == {1: (1.0, 3)}
    assert sums(spark, [(1, x) for x in (1e16, 1.0, 1.0, -1e16, 1e-20)]) == {1: (2.0, 5)}
    assert sums(spark, [(1, 0.1)] * 10) == {1: (1.0, 10)}
    assert sums(spark, [(1, 0.0), (1, -0.0)]) == {1: (0.0, 2)}


def test_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, inf), (1, 2.0), (2, inf), (2, -inf), (3, nan), (3, 1.0), (4, None), (5, None), (5, 3.0), (None, 7.5)]
    rows += [(6, 1.7e308), (6, 1.7e308), (7, 1.7e308)]
    found = sums(spark, rows)
    assert found[1] == (inf, 2) and found[4] == (None, 0) and found[5] == (3.0, 1) and found[None] == (7.5, 1)
    assert math.isnan(found[2][0]) and math.isnan(found[3][0])
    assert found[6] == (inf, 2) and found[7] == (1.7e308, 1)
    assert sums(spark, []) == {}


def test_no_keys_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.25)], "bin int, high double")
    assert binned_sums(df, [], "high", "low", "n").collect()[0]["low"] == 0.75
    assert {tuple(r) for r in binned_sums(df, ["bin"], "high", "high", "low").collect()} == {(1, 0.5, 1), (2, 0.25, 1)}


def test_units(spark):
    chance = random.Random(3)
    cents = [chance.randrange(-(10**15), 10**15) for _ in range(500)]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "x double").repartition(6)
    row = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert row["s"] == sum(cents) / 100
    assert row["a"] == sum(cents) / 100 / 500
    assert df.where("x IS NULL").agg(exact_sum("x").alias("s")).first()["s"] is None
    fine = spark.createDataFrame([(c / 10**4,) for c in cents[:9] if abs(c) < 2**53], "x double")
    assert fine.agg(exact_sum("x", scale=4).alias("s")).first()["s"] == sum(c for c in cents[:9]) / 10**4


@pytest.mark.parametrize("value", [0.001, 1e16, float("nan"), float("inf")])
def test_units_are_checked(spark, value):
    with pytest.raises(PySparkException, match="decimals, or too large"):
        spark.createDataFrame([(value,)], "x double").agg(exact_sum("x")).collect()
