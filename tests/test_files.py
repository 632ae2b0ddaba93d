"""File sources and sinks: modes, codecs, bad records, errors."""

import json
import logging
from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from rows import plan, same_rows

from millrace import scratch
from millrace.operators.relations import sql_over
from millrace.plans import nesting
from millrace.sinks import files as sinks
from millrace.sources.files import read_csv, read_json, table
from millrace.sources.inline import inline_rows, steps_between

DDL = "id int, since date, price double"
LINES = "id,since,price\n1,2020-01-01,1.5\nx,2020-01-02,2.5\n3,soon,3.5\n4,2020-01-04,4.5,more\n5\n"


@pytest.fixture
def dirty(tmp_path):
    file = tmp_path / "dirty.csv"
    file.write_text(LINES)
    return str(file)


def test_permissive_keeps_the_raw_line(spark, dirty):
    rows = {r["bad"]: r for r in read_csv(spark, dirty, DDL, bad_record="bad").collect()}
    assert set(rows) == {None, "x,2020-01-02,2.5", "3,soon,3.5", "4,2020-01-04,4.5,more", "5"}
    assert rows["x,2020-01-02,2.5"]["id"] is None
    assert rows["3,soon,3.5"]["since"] is None and rows["3,soon,3.5"]["price"] == 3.5
    assert rows["5"]["price"] is None and rows["5"]["id"] == 5


def test_bad_rows_are_found_whatever_is_selected(spark, dirty):
    dropped = read_csv(spark, dirty, DDL, mode="DROPMALFORMED")
    assert dropped.count() == 1
    assert [r.id for r in dropped.select("id").collect()] == [1]
    flagged = read_csv(spark, dirty, DDL, bad_record="bad").select("id", "bad")
    assert flagged.where("bad IS NOT NULL").count() == 4


def test_failfast_raises(spark, dirty):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, dirty, DDL, mode="FAILFAST").count()


def test_csv_arguments(spark, dirty):
    with pytest.raises(ValueError, match="mode"):
        read_csv(spark, dirty, DDL, mode="LENIENT")
    with pytest.raises(ValueError, match="declared schema"):
        read_csv(spark, dirty, bad_record="bad")


def test_inferred_types(spark, tmp_path):
    (tmp_path / "clean.csv").write_text("id;price;since\n1;2.5;2020-01-01\n")
    types = dict(read_csv(spark, str(tmp_path / "clean.csv"), sep=";").dtypes)
    assert types == {"id": "int", "price": "double", "since": "date"}


def test_json_number_becomes_text(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": 1, "contact": [9000010000, 9000010001]}\n')
    row = read_json(spark, str(tmp_path / "one.json"), "contact array<string>").first()
    assert row["contact"] == ["9000010000", "9000010001"]


def test_multi_line_document(spark, tmp_path):
    (tmp_path / "one.json").write_text('{\n "id": 1,\n "items": [\n  {"qty": 2}\n ]\n}\n')
    row = read_json(spark, str(tmp_path / "one.json"), multi_line=True).first()
    assert row["id"] == 1 and row["items"][0]["qty"] == 2


def test_documents_are_written_record_by_record(spark, tmp_path, monkeypatch):
    lines = spark.range(0, 21, 1, 2).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "2.0D AS l_quantity",
        "CAST(id AS double) AS l_extendedprice", "0.1D AS l_discount", "IF(id % 2 = 0, 0.5D, NULL) AS l_tax",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    write, plans = DataFrameWriter.text, []
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a: (plans.append(plan(self._df)), write(self, *a))[1])
    monkeypatch.setattr(nesting, "fresh_path", lambda *_: str(tmp_path / "documents"))
    monkeypatch.setattr(nesting, "_FILE_BITS", 2)
    found = nesting.json_multiline_scan(spark, str(tmp_path))
    same_rows(found, nesting._flat(nesting.order_records(spark, str(tmp_path))))
    assert plans and "collect_list" not in plans[0]  # no document is held whole
    files = [json.loads(p.read_text()) for p in (tmp_path / "documents").rglob("part-*") if p.stat().st_size]
    assert all(1 <= len(f) <= 4 for f in files) and sum(map(len, files)) == 21


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, items array<int>")
    assert df.select("id", F.explode("items")).count() == 2
    assert df.select("id", F.explode_outer("items")).count() == 4


@pytest.mark.parametrize("name", ["snappy", "GZIP", "zstd", "none"])
def test_codec_names(spark, small, tmp_path, name):
    region = table(spark, small, "region")
    assert sinks.write_parquet(region, str(tmp_path / "out"), codec=name) == 5
    marker = {"snappy": ".snappy.", "GZIP": ".gz.", "zstd": ".zstd.", "none": "-c000.parquet"}[name]
    assert list((tmp_path / "out").glob(f"*{marker}*"))


def test_unknown_codec_warns_and_lzo_is_refused(caplog):
    with caplog.at_level(logging.WARNING):
        assert sinks.parquet_codec("brotlish") == "snappy"
    assert "brotlish" in caplog.text
    with pytest.raises(ValueError, match="lzo"):
        sinks.parquet_codec("LZO")


def test_default_mode_refuses_existing_path(spark, small, tmp_path):
    region = table(spark, small, "region")
    region.write.csv(str(tmp_path / "out"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        region.write.csv(str(tmp_path / "out"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_single_file(region, str(tmp_path / "out"))


def test_single_file(spark, small, tmp_path):
    nation = table(spark, small, "nation").repartition(4)
    sinks.write_single_file(nation, str(tmp_path / "one"), header=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1


def test_a_large_result_becomes_several_files(spark, folder, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        sinks.write_single_file(table(spark, folder, "lineitem"), str(tmp_path / "many"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "many").glob("part-*.csv"))) > 1


def test_partition_folders_are_pruned(spark, folder, tmp_path):
    customer = table(spark, folder, "customer")
    sinks.write_parquet(customer, str(tmp_path / "c"), partition_by=["c_mktsegment"])
    stored = spark.read.schema(customer.schema).parquet(str(tmp_path / "c"))
    found = stored.where("c_mktsegment = 'BUILDING' AND c_acctbal > 5000").select("c_custkey")
    text = plan(found)
    assert "PartitionFilters: [isnotnull(c_mktsegment" in text
    assert "GreaterThan(c_acctbal,5000.0)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in text


def test_partition_column_type_is_kept_by_the_schema(spark, tmp_path):
    df = spark.createDataFrame([("001", 1)], "code string, n int")
    sinks.write_parquet(df, str(tmp_path / "p"), partition_by=["code"])
    read = spark.read.schema("n int, code string").parquet(str(tmp_path / "p"))
    assert read.first()["code"] == "001"


def test_keyed_extracts(spark, folder, tmp_path):
    customer = table(spark, folder, "customer")
    sinks.write_keyed_extracts(customer, "c_mktsegment", ["Building"], str(tmp_path / "x"), header=True)
    folders = [p.name for p in (tmp_path / "x").iterdir() if p.is_dir()]
    assert folders == ["extract_key=building"]
    one = read_csv(spark, str(tmp_path / "x" / "extract_key=building"), customer.schema)
    same_rows(one, customer.where("c_mktsegment = 'BUILDING'"))


def test_stamp_is_one_text(spark, small):
    stamped = sinks.stamp(table(spark, small, "region"), datetime(2024, 1, 2, 3, 4, 5))
    values = stamped.select(sinks.STAMP).distinct().collect()
    assert [r[0] for r in values] == ["2024-01-02 03:04:05"]


def test_views_are_gone_after_a_query(spark, small):
    region = table(spark, small, "region")
    assert sql_over(spark, "SELECT COUNT(*) AS n FROM some_view", some_view=region).first()["n"] == 5
    assert not spark.catalog.tableExists("some_view")
    region.createTempView("taken")
    try:
        with pytest.raises(Exception, match="taken"):
            sql_over(spark, "SELECT * FROM taken", taken=region)
        assert spark.catalog.tableExists("taken")
    finally:
        spark.catalog.dropTempView("taken")


def test_catalog_lists_databases_and_tables(spark, small, tmp_path):
    table(spark, small, "region").write.option("path", str(tmp_path / "t")).saveAsTable("listed_region")
    try:
        assert spark.sql("SHOW DATABASES").count() >= 1
        assert spark.sql("SHOW TABLES IN default").where("tableName = 'listed_region'").count() == 1
        described = spark.sql("DESCRIBE EXTENDED listed_region").where("col_name = 'r_name'")
        assert described.first()["data_type"] == "string"
    finally:
        spark.sql("DROP TABLE listed_region")


def test_inline_rows_and_steps(spark):
    df = inline_rows(spark, [(1, "a"), (25, "b")], "n int, s string")
    assert [r[0] for r in steps_between(spark, df, "n", 10).orderBy("id").collect()] == [0, 10, 20]
    assert steps_between(spark, df.where("n > 99"), "n", 10).count() == 0


def test_zone_name(spark):
    assert spark.sql("SELECT date_format(TIMESTAMP '2024-01-01 00:00:00', 'z') AS z").first()["z"] == "UTC"


def test_scratch_follows_the_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch.fresh_path(spark, "a"), scratch.fresh_path(spark, "a")
    assert one != other and one.startswith(shared + "/")
