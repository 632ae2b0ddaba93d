"""Rows written in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A local table, which needs no Python worker and whose size the planner knows."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {name: [row[i] for row in rows] for i, name in enumerate(declared.names)}
    return spark.createDataFrame(pa.table(columns), declared)


def steps_between(
    spark: SparkSession, df: DataFrame, column: str, step: int, name: str = "id"
) -> DataFrame:
    """Multiples of ``step`` from the smallest to the largest value of ``column``.

    Only the two ends pass through the driver; the sequence itself is distributed.
    """
    low, high = df.agg(
        F.floor(F.min(column) / step).cast("bigint"), F.floor(F.max(column) / step).cast("bigint")
    ).first()
    if low is None:
        low, high = 0, -1
    return spark.range(low * step, (high + 1) * step, step).withColumnRenamed("id", name)
