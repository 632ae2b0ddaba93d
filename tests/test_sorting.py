"""Sorts with frequent values: balanced tasks, order kept over files."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.sorting import balanced_sort, file_facts, runs_in_files, write_sorted
from millrace.sources.files import footer_facts, table, with_source_file


@pytest.fixture
def eight_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_values_divide(spark, folder, tmp_path, eight_tasks):
    lines = table(spark, folder, "lineitem").withColumn("one", F.lit("same"))
    for n, keys in enumerate((["l_returnflag"], ["one"], [F.col("l_returnflag").desc(), "l_linestatus"])):
        path = str(tmp_path / str(n))
        write_sorted(lines, keys, path)
        stored = spark.read.parquet(path)
        sizes = [r["n"] for r in stored.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 8 and sum(sizes) == lines.count()
        assert max(sizes) <= 1.5 * lines.count() / 8
    names = sorted(f for f in spark.read.parquet(str(tmp_path / "2")).inputFiles())
    flags = [r[0] for f in names for r in spark.read.parquet(f).select("l_returnflag").collect()]
    assert flags == sorted(flags, reverse=True)


def test_plain_sort_gives_equal_values_to_one_task(spark, folder, eight_tasks):
    """What the position is for."""
    lines = table(spark, folder, "lineitem")
    parts = lambda df: df.groupBy(F.spark_partition_id()).count().count()
    assert parts(lines.orderBy("l_returnflag")) <= 3 < parts(balanced_sort(lines, ["l_returnflag"])) == 8


def test_order_of_equal_rows_is_kept(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("at", F.monotonically_increasing_id())
    rows = balanced_sort(lines, ["l_linestatus"]).select("l_linestatus", "at").collect()
    assert rows == sorted(rows)


def test_shuffled_rows_need_a_key(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("k")).repartition(4, "k")
    with pytest.raises(ValueError, match="row_key"):
        balanced_sort(df, ["k"])
    rows = [tuple(r) for r in balanced_sort(df, ["k"], row_key=["id"]).select("k", "id").collect()]
    assert rows == sorted(rows)


def test_facts_see_disorder(spark, tmp_path):
    for name, values in (("good", "aabbc"), ("gap", "abab"), ("back", "bbaa")):
        path = str(tmp_path / name)
        spark.createDataFrame([(v,) for v in values], "v string").coalesce(1).write.parquet(path)
        (fact,) = file_facts(runs_in_files(spark.read.parquet(path), "v")).collect()
        assert fact["in_order"] == (name == "good") and fact["n_rows"] == len(values)


def test_rows_know_their_file(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.range(30).repartition(3).write.parquet(path)
    rows = with_source_file(spark.read.parquet(path), "file")
    assert {r["file"].rsplit("/", 1)[1] for r in rows.collect()} == {
        f.rsplit("/", 1)[1] for f in spark.read.parquet(path).inputFiles()
    }


def test_footers_are_enough(spark, folder, monkeypatch):
    seen = type(spark.range(1))
    plans, first = [], seen.first
    monkeypatch.setattr(seen, "first", lambda df: plans.append(df._jdf.queryExecution().toString()) or first(df))
    settings = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    facts = footer_facts(spark, f"{folder}/lineitem.parquet", "l_orderkey", "n", "low", "high")
    monkeypatch.undo()
    assert "PushedAggregation: [COUNT(*), MIN(l_orderkey), MAX(l_orderkey)]" in plans[0]
    assert {k: spark.conf.get(k, None) for k in settings} == settings
    lines = table(spark, folder, "lineitem")
    assert tuple(facts.first()) == tuple(lines.agg(F.count("*"), F.min("l_orderkey"), F.max("l_orderkey")).first())
