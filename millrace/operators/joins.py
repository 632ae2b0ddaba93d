"""Equi-joins that stay balanced when one key holds much of the left table.

``left`` is the large, possibly skewed side; ``right`` is the side looked up.
Keys of both sides must have equal types, because salting compares key hashes.
Result columns are those of ``left`` followed by those of ``right``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sizing import (
    BROADCAST_LIMIT_BYTES,
    HotKeys,
    hot_keys,
    measure,
    with_parts,
)

_UNSTEADY = re.compile(r"(?<!Broadcast)Exchange|\b(?:Global|Local|Collect)Limit\b|^\W*Sample\b", re.MULTILINE)
SALTS = 32
SALT = "_salt"
_PARTS = "_salt_parts"
_JOIN_TYPES = ("inner", "left")


def _check(left: DataFrame, right: DataFrame, left_on, right_on, how: str) -> None:
    if how not in _JOIN_TYPES:
        raise ValueError(f"join type {how!r} is not one of {_JOIN_TYPES}")
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"rename columns found on both sides: {sorted(shared)}")
    for a, b in zip(left_on, right_on, strict=True):
        if left.schema[a].dataType != right.schema[b].dataType:
            raise ValueError(f"cast {a} and {b} to one type before joining")
        if isinstance(left.schema[a].dataType, (T.FloatType, T.DoubleType)):
            raise ValueError(f"floating-point join key {a}")


def _condition(
    left_on: Sequence[str],
    right_on: Sequence[str],
    residual: Column | None,
    null_safe: bool,
) -> Column:
    pairs = [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
        for a, b in zip(left_on, right_on, strict=True)
    ]
    if residual is not None:
        pairs.append(residual)
    return reduce(lambda x, y: x & y, pairs)


def check_repeatable(df: DataFrame, row_key: Sequence[str] | None) -> None:
    """Refuse to salt by row position what a retry may put in another order.

    That would lose or double rows; ``row_key`` names columns that are unique per row
    instead. Seen in the plan are shuffles, limits and samples. What an RDD or a Python
    function yields is not, so name a key there, too, unless it always yields the same.
    """
    if not row_key and _UNSTEADY.search(df._jdf.queryExecution().toString()):
        raise ValueError("rows come out of a shuffle, limit or sample: name unique columns with row_key")


def add_salt(
    df: DataFrame,
    keys: Sequence[str],
    salts: int = SALTS,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Deal the rows of each key over ``salts`` salts, or over its parts in ``hot``.

    Without ``row_key`` the row's position decides, which also spreads equal
    rows; hashed, so that it does not keep step with a pattern in the keys.
    Positions repeat on a retry only if the rows come straight from files;
    rows out of a shuffle need columns that are unique per row.
    """
    check_repeatable(df, row_key)
    spread = F.xxhash64(*(row_key or [F.monotonically_increasing_id()]))
    if hot is None:
        return df.withColumn(SALT, F.pmod(spread, F.lit(salts)).cast("int"))
    parted = with_parts(df, keys, hot, _PARTS)
    return parted.withColumn(SALT, F.pmod(spread, F.col(_PARTS)).cast("int")).drop(_PARTS)


def add_all_salts(
    df: DataFrame,
    keys: Sequence[str],
    salts: int = SALTS,
    hot: HotKeys | None = None,
    name: str = SALT,
) -> DataFrame:
    """Copy each row once per salt that ``add_salt`` can give its key."""
    if hot is None:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    parted = with_parts(df, keys, hot, _PARTS)
    return parted.withColumn(name, F.explode(F.sequence(F.lit(0), F.col(_PARTS) - 1))).drop(_PARTS)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    salts: int = SALTS,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
    residual: Column | None = None,
    null_safe: bool = False,
    hint: str | None = "merge",
) -> DataFrame:
    """Shuffle join on (key, salt); both sides use one salt range, so no match is lost.

    The hint keeps Spark from broadcasting the copies, whose number it does not
    foresee. It can go where ``right`` comes out of a shuffle, whose size it sees.
    """
    _check(left, right, left_on, right_on, how)
    copies = "_salt_right"
    salted = add_salt(left, left_on, salts, hot, row_key)
    copied = add_all_salts(right, right_on, salts, hot, copies)
    if hint:
        copied = copied.hint(hint)
    matched = _condition(left_on, right_on, residual, null_safe)
    joined = salted.join(copied, (F.col(SALT) == F.col(copies)) & matched, how)
    return joined.drop(SALT, copies)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    limit: int | None = None,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
    residual: Column | None = None,
    null_safe: bool = False,
    hint: str | None = None,
) -> DataFrame:
    """Broadcast a small ``right``, else shuffle with the hot keys of ``left`` salted.

    Small means at most ``limit`` bytes as measured (``BROADCAST_LIMIT_BYTES``
    unless given). Hot keys not given are found by reading ``left`` once more;
    each side is measured in one pass at most. A hint asks for a certain shuffle
    join, so nothing is broadcast then.
    """
    _check(left, right, left_on, right_on, how)
    limit = BROADCAST_LIMIT_BYTES if limit is None else limit
    if hint is None and measure(right).bytes <= limit:
        hint, hot = "broadcast", {}
    elif hot is None:
        check_repeatable(left, row_key)
        hot = hot_keys(left, left_on)
    if hot:
        return salted_join(
            left, right, left_on, right_on, how,
            hot=hot, row_key=row_key, residual=residual, null_safe=null_safe, hint=hint or "merge",
        )
    if hint:
        right = right.hint(hint)
    return left.join(right, _condition(left_on, right_on, residual, null_safe), how)


def merge_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Sort-merge join of two large tables."""
    return keyed_join(left, right, left_on, right_on, how, hot=hot, row_key=row_key, hint="merge")


def hash_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    limit: int = BROADCAST_LIMIT_BYTES,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffle-hash join, if each partition of ``right`` fits in a hash table.

    The limit holds for the even share of one shuffle partition. A right table
    with a hot key is not joined so, since no partitioning could divide that key.
    """
    _check(left, right, left_on, right_on, how)
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = measure(right, right_on)
    hint = "shuffle_hash" if found.bytes <= limit * partitions and not found.hot else "merge"
    return keyed_join(left, right, left_on, right_on, how, row_key=row_key, hint=hint)


def bucketed_pair(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    tables: tuple[str, str],
    paths: tuple[str, str],
    buckets: int,
    *,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
) -> None:
    """Write both tables bucketed alike, so that joining them needs no shuffle.

    The bucket is of key and salt: hot keys are spread over buckets when they
    are written, and stay spread at every later join.
    """
    _check(left, right, left_on, right_on, "left")
    if hot is None:
        check_repeatable(left, row_key)
        hot = hot_keys(left, left_on)
    sides = (
        (add_salt(left, left_on, hot=hot, row_key=row_key), left_on),
        (add_all_salts(right, right_on, hot=hot), right_on),
    )
    for (df, keys), table, path in zip(sides, tables, paths, strict=True):
        by = [*keys, SALT]
        (
            df.repartition(buckets, *by)  # one file per bucket
            .write.mode("overwrite").format("parquet")
            .bucketBy(buckets, *by).option("path", path).saveAsTable(table)
        )


def bucketed_join(
    spark: SparkSession,
    tables: tuple[str, str],
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join two tables written by ``bucketed_pair``."""
    left = spark.table(tables[0])
    right = spark.table(tables[1]).withColumnRenamed(SALT, "_salt_right").hint("merge")
    matched = _condition([*left_on, SALT], [*right_on, "_salt_right"], None, False)
    return left.join(right, matched, how).drop(SALT, "_salt_right")
