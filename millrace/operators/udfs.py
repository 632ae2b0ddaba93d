"""A scalar Python function, its SQL registration and its native twin."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.operators.joins import keyed_join
from millrace.scratch import fresh_name


@F.pandas_udf(DoubleType())
def charge(price: pd.Series, discount: pd.Series, tax: pd.Series) -> pd.Series:
    """What is paid after discount and tax; works on whole Arrow batches."""
    return price * (1 - discount) * (1 + tax)


@contextmanager
def registered_charge(spark: SparkSession) -> Iterator[str]:
    """A name under which SQL finds ``charge``, for the length of a ``with`` block.

    Queries resolved inside keep working afterwards.
    """
    name = fresh_name("charge")
    spark.udf.register(name, charge)
    try:
        yield name
    finally:
        spark.sql(f"DROP TEMPORARY FUNCTION {name}")


def native_charge(price: str, discount: str, tax: str) -> Column:
    """Prefer this one: it stays in generated code."""
    return F.col(price) * (1 - F.col(discount)) * (1 + F.col(tax))


def lookup(
    df: DataFrame,
    key: str,
    dimension: DataFrame,
    dimension_key: str,
    row_key: list[str] | None = None,
) -> DataFrame:
    """Add the columns of a dimension; unknown keys get nulls."""
    joined = keyed_join(df, dimension, [key], [dimension_key], "left", row_key=row_key)
    return joined.drop(dimension_key)
