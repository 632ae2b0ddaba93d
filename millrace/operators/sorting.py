"""Sorting tables in which one value of the sort key has many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import check_repeatable

_AT = "_sort_at"


def balanced_sort(
    df: DataFrame, order_by: Sequence[str | Column], *, row_key: Sequence[str] | None = None
) -> DataFrame:
    """``df`` in the order of ``order_by``, with equal rows divided among tasks.

    A sort deals rows by ranges whose ends are sampled values, and cannot cut between
    equal ones. With the row's position as last key no two rows are equal, so ranges end
    within a frequent value, too; and rows keep their order where the sort leaves it
    open. Positions repeat on a retry only where rows come straight from files; rows out
    of a shuffle need ``row_key``, columns that are unique per row.
    """
    check_repeatable(df, row_key)
    if row_key:
        return df.orderBy(*order_by, *row_key)
    return df.withColumn(_AT, F.monotonically_increasing_id()).orderBy(*order_by, _AT).drop(_AT)


def write_sorted(
    df: DataFrame, order_by: Sequence[str | Column], path: str, *, row_key: Sequence[str] | None = None
) -> None:
    """Write ``df`` so that its files, by name, and the rows in each are in order."""
    balanced_sort(df, order_by, row_key=row_key).write.mode("error").parquet(path)


def runs_in_files(df: DataFrame, column: str) -> DataFrame:
    """Where each value of ``column`` lies in the files that ``df`` was read from.

    Per file and value the first and last row and their number. A file is in order if its
    runs have no gaps and do not overlap; there is a row per file and value, not per row.
    """
    place = F.col("_metadata.row_index")
    return df.groupBy(F.col("_metadata.file_name").alias("file_name"), F.col(column).alias("value")).agg(
        F.min(place).alias("first_row"), F.max(place).alias("last_row"), F.count(F.lit(1)).alias("n_rows")
    )


def file_facts(runs: DataFrame) -> DataFrame:
    """Per file its rows, smallest and largest value, and whether its runs are in order."""
    run = F.struct("first_row", "last_row", "n_rows", "value")
    runs = runs.groupBy("file_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.array_sort(F.collect_list(run)).alias("runs"),
    )
    whole = F.forall("runs", lambda r: r["last_row"] - r["first_row"] + 1 == r["n_rows"])
    rising = F.transform("runs", lambda r: r["value"]) == F.array_sort(F.transform("runs", lambda r: r["value"]))
    return runs.withColumn("in_order", whole & rising).drop("runs")
