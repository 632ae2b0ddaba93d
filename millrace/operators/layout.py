"""Partitioning, clustering and the reports that show their effect."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import SALT, add_salt, check_repeatable
from millrace.operators.sizing import HotKeys, hot_keys, quantiles

LEAST_BITS = 6
MOST_BITS = 12


def spread_by_key(
    df: DataFrame,
    keys: Sequence[str],
    partitions: int | None = None,
    *,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Hash partitioning by key in which hot keys take several partitions."""
    if hot is None:
        check_repeatable(df, row_key)
        hot = hot_keys(df, keys)
    count = [partitions] if partitions else []
    if not hot:
        return df.repartition(*count, *keys)
    salted = add_salt(df, keys, hot=hot, row_key=row_key)
    return salted.repartition(*count, *keys, SALT).drop(SALT)


def partition_report(df: DataFrame) -> DataFrame:
    """Rows in each physical partition."""
    placed = df.select(F.spark_partition_id().alias("partition_id"))
    return placed.groupBy("partition_id").agg(F.count(F.lit(1)).alias("n_rows"))


def file_min_max(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Range of ``column`` in each file read, and in each of ``by`` within it."""
    report = df.groupBy(*by, F.col("_metadata.file_name").alias("file_name")).agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return report.orderBy(*by, "min_value", "file_name")


def _as_double(df: DataFrame, column: str) -> Column:
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    raise ValueError(f"cannot cluster by {column} of type {kind.simpleString()}")


def _text_edges(df: DataFrame, column: str, parts: int) -> list[str]:
    """Lower ends of ``parts`` ranges of a text column but the first, as Spark cuts them."""
    ranged = df.select(column).where(F.col(column).isNotNull()).repartitionByRange(parts, column)
    ends = ranged.groupBy(F.spark_partition_id()).agg(F.min(column).alias("end"))
    return sorted((r["end"] for r in ends.collect()), key=lambda end: end.encode())[1:]


def zorder_bits(files: int, columns: int) -> int:
    """Bits per column, such that cells of the curve outnumber the files by far.

    At most ``MOST_BITS``, as 2**bits band edges go into the plan; beyond them the
    columns themselves order the rows of a cell.
    """
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(files, 2)) / columns) + 3))


def with_zorder(df: DataFrame, columns: Sequence[str], name: str, bits: int) -> DataFrame:
    """Add the interleaved bits of the quantile bands of ``columns``.

    Numbers, dates, timestamps and text work. A band is found by bisection, one
    bit per step; each step is a projection of its own, which keeps the generated
    code short enough to be compiled.
    """
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    values = {c: f"_value_{c}" for c in columns}
    bands = [f"_band_{column}" for column in columns]
    ranked = df.withColumns(
        {values[c]: F.col(c) if c in text else _as_double(df, c) for c in columns}
    )
    numbers = [values[c] for c in columns if c not in text]
    found: dict[str, list] = quantiles(ranked, numbers, 2**bits) if numbers else {}
    found |= {values[c]: _text_edges(df, c, 2**bits) for c in text}
    kinds = {values[c]: "string" if c in text else "double" for c in columns}
    edges = {v: F.array(*[F.lit(e) for e in found[v]]).cast(f"array<{kinds[v]}>") for v in found}
    ranked = ranked.withColumns({band: F.lit(0) for band in bands})
    for bit in reversed(range(bits)):
        half = 2**bit
        ranked = ranked.withColumns(
            {
                band: F.col(band)
                + F.when(F.col(values[c]) >= F.get(edges[values[c]], F.col(band) + (half - 1)), half).otherwise(0)
                for c, band in zip(columns, bands, strict=True)
            }
        )
    digits = [
        F.expr(f"shiftleft(CAST(shiftright({band}, {bit}) & 1 AS BIGINT), {bit * len(columns) + i})")
        for i, band in enumerate(bands)
        for bit in range(bits)
    ]
    value = reduce(lambda a, b: a + b, digits)
    return ranked.withColumn(name, value).drop(*values.values(), *bands)


def zorder_rewrite(
    df: DataFrame,
    columns: Sequence[str],
    path: str,
    *,
    where: Column | None = None,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    bits: int | None = None,
) -> None:
    """Write ``df``, or the partition ``where`` selects, clustered by ``columns``.

    ``path`` must be new. The columns themselves and the row's position follow
    the interleaved value in the range, so even equal rows divide into files.
    ``df`` should come straight from files, where positions repeat on a retry.
    """
    rows = df if where is None else df.where(where)
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    if bits is None:
        expected = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bits = zorder_bits(expected, len(columns))
    ranked = with_zorder(placed, columns, "_z", bits)
    key = [*partition_by, "_z", *columns, "_at"]
    count = [files] if files else []
    clustered = ranked.repartitionByRange(*count, *key).sortWithinPartitions(*key)
    writer = clustered.drop("_z", "_at").write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
