"""Ranks and running sums of whole groups, however large one of them is.

A window function needs all rows of a group in one task. For groups with more rows than
an even partition this goes in two passes instead: their rows are cut into ranges of the
order, ranks and sums are taken within each range, and what came before each range, a
row per range, is summed up and added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sizing import HotKeys, hot_keys, with_parts
from millrace.scratch import fresh_path

_PARTS, _SLICE = "_scan_parts", "_scan_slice"
_NUMBER, _RANK, _DENSE, _ROWS = "row_number", "rank", "dense_rank", "group_rows"


def _names(order_by: Sequence[str]) -> list[str]:
    return [c.removeprefix("-") for c in order_by]


def _sorted_by(order_by: Sequence[str]) -> list[Column]:
    """A leading minus means from large to small; nulls come first, or then last."""
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order_by]


def _within(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[str],
    row_key: Sequence[str],
    running: Mapping[str, Column],
) -> DataFrame:
    """Ranks and running sums by Spark's own windows over ``groups``."""
    group = Window.partitionBy(*groups)
    tied = group.orderBy(*_sorted_by(order_by))
    single = group.orderBy(*_sorted_by(order_by), *row_key)
    so_far = single.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {name: F.sum(value).over(so_far) for name, value in running.items()}
        | {
            _NUMBER: F.row_number().over(single).cast("bigint"),
            _RANK: F.rank().over(tied).cast("bigint"),
            _DENSE: F.dense_rank().over(tied).cast("bigint"),
        }
    )


def _before(ranked: DataFrame, keys: Sequence[str], order_by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per group and range what lies before it: rows, different values, ties and sums.

    Rows of one order value can fill the end of a range, whole ranges and the start of
    another. They share the rank of the first of them, found in the last range in which a
    value other than the one it began with, or not carried over, came last.
    """
    value = F.struct(*_names(order_by))
    facts = ranked.groupBy(*keys, _SLICE).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(_DENSE).alias("different"),
        F.max(_RANK).alias("last_rank"),
        F.min_by(value, _NUMBER).alias("first"),
        F.max_by(value, _NUMBER).alias("last"),
        *[F.max_by(name, _NUMBER).alias(f"_sum_{name}") for name in sums],
    )
    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name).over(earlier), F.lit(0))

    goes_on = F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(by_slice)), F.lit(False))
    facts = facts.withColumns({"goes_on": goes_on, "rows_before": total("n")})
    begins = F.when(
        ~(F.col("goes_on") & (F.col("different") == 1)), F.col("rows_before") + F.col("last_rank")
    )
    facts = facts.withColumn("tie_begins", F.last(begins, ignorenulls=True).over(so_far))
    carried = F.sum(F.col("goes_on").cast("bigint")).over(so_far)
    return facts.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.col(_SLICE).alias("_of_slice"),
        "goes_on",
        "rows_before",
        F.lag("tie_begins").over(by_slice).alias("tie_before"),
        (total("different") - carried).alias("different_before"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("_group_rows"),
        *[F.sum(f"_sum_{name}").over(earlier).alias(f"_sum_{name}") for name in sums],
    )


def group_ranks(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    *,
    row_key: Sequence[str],
    running: Mapping[str, Column] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every row with ``row_number``, ``rank``, ``dense_rank``, ``group_rows`` and running sums.

    ``order_by`` names columns, with a leading minus for descending; rows equal in them are
    numbered, and summed, in the order of ``row_key``, which must tell all rows of a group
    apart. ``running`` gives names to sums up to and including a row; pass whole numbers or
    decimals for sums that do not depend on where ranges are cut. Null keys are a group.

    Groups of ordinary size go through one shuffle and Spark's windows. Rows of hot groups
    (see ``hot_keys``) are shuffled by ranges of the order first and windowed per range; that
    result is written, so that the facts of the ranges, at most one more than twice the
    shuffle partitions for each hot group, come from it and are broadcast back.
    """
    running = dict(running or {})
    keys = list(partition_by)
    made = [_NUMBER, _RANK, _DENSE, _ROWS, *running]
    taken = set(df.columns) & {*made, _PARTS, _SLICE}
    if taken:
        raise ValueError(f"rename columns {sorted(taken)}")
    whole = Window.partitionBy(*keys)
    hot = hot_keys(df, keys) if hot is None else hot
    parted = with_parts(df, keys, hot, _PARTS)
    cold = parted.where(F.col(_PARTS) == 1).drop(_PARTS)
    cold = _within(cold, keys, order_by, row_key, running).withColumn(_ROWS, F.count(F.lit(1)).over(whole))
    if not hot:
        return cold.select(*df.columns, *made)
    ranges = sum(hot.values())
    sliced = parted.where(F.col(_PARTS) > 1).repartitionByRange(ranges, *keys, *_sorted_by(order_by), *row_key)
    ranked = _within(
        sliced.drop(_PARTS).withColumn(_SLICE, F.spark_partition_id()),
        [*keys, _SLICE], order_by, row_key, running,
    )
    path = fresh_path(df.sparkSession, "ranked-ranges")
    ranked.write.parquet(path)
    ranked = df.sparkSession.read.schema(ranked.schema).parquet(path)
    before = _before(ranked, keys, order_by, list(running))
    same = F.col(_SLICE) == F.col("_of_slice")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    joined = ranked.join(F.broadcast(before), same)
    carried = F.col("goes_on") & (F.col(_RANK) == 1)
    warm = joined.select(
        *df.columns,
        (F.col("rows_before") + F.col(_NUMBER)).alias(_NUMBER),
        F.when(carried, F.col("tie_before")).otherwise(F.col("rows_before") + F.col(_RANK)).alias(_RANK),
        (F.col("different_before") + F.col(_DENSE)).alias(_DENSE),
        F.col("_group_rows").alias(_ROWS),
        *[
            # A sum is null until the first value that is not.
            F.when(F.col(name).isNull(), F.col(f"_sum_{name}"))
            .otherwise(F.col(name) + F.coalesce(f"_sum_{name}", F.lit(0)))
            .cast(ranked.schema[name].dataType)
            .alias(name)
            for name in running
        ],
    )
    return warm.unionByName(cold.select(*warm.columns))
