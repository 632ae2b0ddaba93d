"""Reports built from one map-side aggregated pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def value_frequency(df: DataFrame, column: str, name: str = "n_rows") -> DataFrame:
    """Values of a column with their row counts, most common first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.col(name).desc(), column)


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and the part of the whole table they make up."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    whole = counts.agg(F.sum("n_rows")).scalar()  # reuses the counts' shuffle
    return counts.withColumn("share", F.col("n_rows") / whole)


def observed_total(df: DataFrame, condition: Column, value: Column) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, with a conditional total that its next action fills in."""
    seen = Observation()
    total = F.sum(F.when(condition, value)).alias("total")
    return df.observe(seen, total, F.count(F.lit(1)).alias("rows")), seen


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type and number of values of each column, from one scan."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in fields])
    rows = [
        F.struct(
            F.lit(f.name).alias("col_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"`{f.name}`").alias("n_values"),
        )
        for f in fields
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def word_count(df: DataFrame, column: str) -> DataFrame:
    """Lower-case words of a text column with their number of occurrences."""
    words = df.select(F.explode(F.split(F.lower(column), r"\s+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def rows_and_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of rows, and of values in each of ``columns``."""
    values = [F.count(c).alias(f"n_{c}") for c in columns]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *values)
