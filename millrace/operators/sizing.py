"""Measurements taken before a join or a layout is chosen.

Each looks at the whole table, or for hot keys alone at a sample, with map-side
aggregation and brings little back: rows and bytes, quantiles, or the hot keys, of
which there cannot be more than partitions. Sketches are merged in two steps, since one task could not
take in those of all others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
_SLOTS_PER_HOT_KEY = 8
_SAMPLED_PER_PARTITION = 1024
_SAMPLE_STEPS = 1 << 40
# Fixed value: Spark's frequent-items sketch gives back at most twice as many.
_HOT_PER_SKETCH = 50_000
_QUANTILE_DETAIL = 800
_MOST_MERGERS = 1_000
_VARIABLE_OVERHEAD = 16
_FIXED_WIDTH = 8

# Key hash -> number of parts the rows of that key should be split into.
HotKeys = dict[int, int]


@dataclass(frozen=True)
class Measured:
    rows: int
    bytes: int
    hot: HotKeys = field(default_factory=dict)


def _width(df: DataFrame) -> Column:
    """Uncompressed size of a row."""
    width: Column = F.lit(_FIXED_WIDTH * len(df.columns)).cast("bigint")
    for column_field in df.schema.fields:
        column = F.col(f"`{column_field.name}`")
        if isinstance(column_field.dataType, (T.StringType, T.BinaryType)):
            text = column
        elif isinstance(column_field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(column))
        else:
            continue
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + _VARIABLE_OVERHEAD
    return width


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _by_merger(df: DataFrame, *more: str) -> GroupedData:
    """Groups of whole partitions, few enough for one task to merge their results."""
    mergers = min(_shuffle_partitions(df), _MOST_MERGERS)
    placed = df.withColumn("_merger", F.pmod(F.spark_partition_id(), F.lit(mergers)))
    return placed.groupBy("_merger", *more)


def measure(df: DataFrame, keys: Sequence[str] = (), *, sizes: bool = True) -> Measured:
    """Rows, bytes (if ``sizes``) and hot ``keys`` of ``df``, from a single pass.

    A key is hot if it has more rows than an even shuffle partition. Its parts are
    such that each is about one partition's worth, rounded up to a power of two.
    Null keys count as one value. At most as many keys as partitions can be hot.

    A frequent-items sketch keeps the state of every task and the answer bounded
    however many distinct keys there are; where partitions outnumber what one can
    give back, the keys are shared out to several. Its counts are estimates, so
    callers may only use the answer to place rows, never to select them.
    """
    partitions = _shuffle_partitions(df)
    slices = math.ceil(partitions / _HOT_PER_SKETCH)
    most = min(partitions, 2 * _HOT_PER_SKETCH)
    slots = most * _SLOTS_PER_HOT_KEY
    width = _width(df) if sizes else F.lit(0).cast("bigint")
    key = key_hash(keys) if keys else F.lit(0).cast("bigint")
    state = df.select(width.alias("width"), key.alias("key"))
    state = state.withColumn("_slice", F.pmod(F.shiftright("key", 40), F.lit(slices)))
    partial = [F.count(F.lit(1)).alias("rows"), F.sum("width").alias("bytes")]
    whole = [F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")]
    if keys:
        partial.append(F.expr(f"approx_top_k_accumulate(key, {slots})").alias("sketch"))
        # Combining fails where a task has no sketch at all, so it works on a group.
        whole.append(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {slots}), {most})").alias("top")
        )
    found = _by_merger(state, "_slice").agg(*partial).groupBy("_slice").agg(*whole).collect()
    rows = sum(r["rows"] for r in found)
    hot: HotKeys = {}
    for row in found if keys else []:
        for item in row["top"]:
            partitions_filled = item["count"] * partitions / rows
            if partitions_filled > 1:
                hot[item["item"]] = 2 ** math.ceil(math.log2(partitions_filled))
    return Measured(rows, sum(r["bytes"] for r in found), hot)


def data_bytes(df: DataFrame) -> int:
    """Uncompressed size of all rows of ``df``."""
    return measure(df).bytes


def fits_in(df: DataFrame, limit: int) -> bool:
    """Whether all rows of ``df`` take at most ``limit`` bytes."""
    return data_bytes(df) <= limit


def hot_keys(df: DataFrame, keys: Sequence[str]) -> HotKeys:
    """The hot keys of ``df`` and their parts (see ``measure``), from a sample.

    Rows are counted first, which for files takes no more than their footers. So many are
    then looked at that even a key which just fills a partition is seen a thousand times; a
    table of no more rows than that is looked at whole. As with any estimate, the
    answer may only place rows. At most twice as many keys as partitions come back.
    """
    partitions = _shuffle_partitions(df)
    rows, wanted = df.count(), partitions * _SAMPLED_PER_PARTITION
    sample = df.select(key_hash(keys).alias("key"))
    if rows > wanted:
        kept = max(1, round(_SAMPLE_STEPS * wanted / rows))
        place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(_SAMPLE_STEPS))
        sample, rows = sample.where(place < kept), rows * kept / _SAMPLE_STEPS
    counts = sample.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot: HotKeys = {}
    for row in counts.where(F.col("n") > F.lit(rows / partitions)).collect():
        hot[row["key"]] = 2 ** math.ceil(math.log2(row["n"] * partitions / rows))
    return hot


def quantiles(df: DataFrame, columns: Sequence[str], parts: int) -> dict[str, list[float]]:
    """The inner ``parts - 1`` quantiles of number columns; none if all are null."""
    sketches = _by_merger(df.select(*columns)).agg(
        *[F.kll_sketch_agg_double(c, _QUANTILE_DETAIL).alias(c) for c in columns]
    )
    ranks = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    whole = sketches.agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])
    filled = [
        F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, ranks)).alias(c)
        for c in columns
    ]
    row = whole.select(*filled).first()
    return {c: row[c] or [] for c in columns}


def with_parts(df: DataFrame, keys: Sequence[str], hot: HotKeys, name: str) -> DataFrame:
    """Add the number of parts of each row's key, 1 unless it is hot.

    The hot keys, at most one per partition, come in as a small broadcast table.
    """
    if not hot:
        return df.withColumn(name, F.lit(1))
    columns = [pa.array(list(hot), pa.int64()), pa.array(list(hot.values()), pa.int32())]
    table = df.sparkSession.createDataFrame(pa.table(columns, names=["_hot_key", "_hot_parts"]))
    joined = df.join(F.broadcast(table), key_hash(keys) == F.col("_hot_key"), "left")
    return joined.withColumn(name, F.coalesce("_hot_parts", F.lit(1))).drop("_hot_key", "_hot_parts")
