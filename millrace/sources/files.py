"""Readers for file formats.

A declared schema saves a pass over the data. Without one, CSV and JSON read
the input once just to guess types; ``samplingRatio`` shortens that.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEAST_HASH = -(2**63)
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    mode: str = "PERMISSIVE",
    bad_record: str | None = None,
    **options: Any,
) -> DataFrame:
    """CSV with a header line.

    ``bad_record`` names a column, added to the schema, for the raw text of rows
    that do not fit it. Wherever bad rows are to be found, all columns are
    parsed: by default Spark parses those a query needs, and a row would then be
    malformed for one query and well-formed for the next.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is not one of {MODES}")
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is None:
        if bad_record:
            raise ValueError("a bad-record column needs a declared schema")
        return reader.option("inferSchema", True).options(**options).csv(path)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if bad_record:
        declared = T.StructType([*declared.fields, T.StructField(bad_record, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_record)
    rows = reader.options(**options).schema(declared).csv(path)
    if bad_record or mode != "PERMISSIVE":
        # True for every row; it is here to name every column.
        rows = rows.where(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]) >= _LEAST_HASH)
    return rows


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    multi_line: bool = False,
    **options: Any,
) -> DataFrame:
    """JSON Lines, or whole-file documents if ``multi_line``.

    A whole-file document cannot be split among tasks; keep such files small.
    """
    reader = spark.read.option("multiLine", multi_line).options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_nested_folders(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All files at any depth; folder names are not turned into columns."""
    return spark.read.format(fmt).option("recursiveFileLookup", True).load(path)


def with_source_file(df: DataFrame, name: str) -> DataFrame:
    """Add the path of the file that each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


@contextmanager
def _set(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings for the length of a ``with`` block."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def footer_facts(spark: SparkSession, path: str, column: str, rows: str, least: str, most: str) -> DataFrame:
    """Number of rows and range of ``column`` of Parquet files, from their footers.

    The second version of Spark's Parquet reader takes counts and ends from the statistics
    of the row groups. Not all columns have any: for texts, times and nested columns, and
    wherever a filter comes first, the same result takes a scan of that column.
    """
    with _set(
        spark,
        **{"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"},
    ):
        facts = spark.read.parquet(path).agg(
            F.count(F.lit(1)).alias(rows), F.min(column).alias(least), F.max(column).alias(most)
        )
        row = facts.first()  # while the settings hold
    return spark.range(1).select(
        *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
    )
