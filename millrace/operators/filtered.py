"""Joins that shuffle only rows which can have a partner."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import keyed_join
from millrace.operators.sizing import BROADCAST_LIMIT_BYTES, hot_keys, measure

#: Bits per key, and of a whole filter, which every task gets.
KEY_BITS = 16
MOST_BITS = 2**26
_WORD_BITS = 64
_PROBES = 3
_HASH_BITS = 50
_MAYBE = "_may_match"


def _places(keys: Sequence[str], bits: int) -> list[Column]:
    """The bits of a key: a hash, and steps of a second, odd one; sums stay in range."""
    first = F.xxhash64(*[F.col(k) for k in keys]).bitwiseAND(F.lit(2**_HASH_BITS - 1))
    step = F.xxhash64(*[F.col(k) for k in keys], F.lit(1)).bitwiseAND(F.lit(2**_HASH_BITS - 1)).bitwiseOR(F.lit(1))
    return [(first + F.lit(i) * step).bitwiseAND(F.lit(bits - 1)) for i in range(_PROBES)]


def filter_bits(rows: int) -> int:
    """Bits of a filter for so many rows, a power of two; 0 if it would be too large."""
    bits = 2 ** max(10, math.ceil(math.log2(max(rows, 1) * KEY_BITS)))
    return bits if bits <= MOST_BITS else 0


def key_filter(df: DataFrame, keys: Sequence[str], bits: int) -> Column:
    """A Bloom filter of the keys of ``df``: an array of words, as a scalar of the query.

    Words are combined map-side. Their number is fixed by ``bits``, whatever the table.
    """
    spark = df.sparkSession
    known = df.select(*keys).dropna()
    place = known.select(F.explode(F.array(*_places(keys, bits))).alias("place"))
    word = F.shiftright("place", int(math.log2(_WORD_BITS))).alias("word")
    bit = F.expr(f"shiftleft(1L, CAST(place & {_WORD_BITS - 1} AS INT))")
    words = place.groupBy(word).agg(F.bit_or(bit).alias("set"))
    # Words without a bit are needed, too, for the others to stand at their places.
    every = spark.range(bits // _WORD_BITS).join(words, F.col("id") == F.col("word"), "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))))
    return every.agg(F.transform(listed, lambda x: x["set"]).alias("words")).scalar()


def may_match(keys: Sequence[str], words: Column, bits: int) -> Column:
    """Whether a key can be in the filter: surely so if it is, rarely if it is not."""
    tests = F.lit(True)
    for place in _places(keys, bits):
        word = F.get(words, F.shiftright(place, int(math.log2(_WORD_BITS))).cast("int"))
        bit = place.bitwiseAND(F.lit(_WORD_BITS - 1)).cast("int")
        tests = tests & (F.call_function("getbit", word, bit) == 1)
    return F.coalesce(tests, F.lit(False))


def filtered_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    row_key: Sequence[str],
    limit: int = BROADCAST_LIMIT_BYTES,
    residual: Column | None = None,
) -> DataFrame:
    """``keyed_join`` in which rows of ``left`` without a partner are not shuffled.

    A Bloom filter of the keys of ``right``, built in one pass over these, is tested while
    ``left`` is scanned. Few rows without a partner pass it; the join removes them. In a left
    join the others get their nulls at once. Where ``right`` has too many rows for a filter
    of ``MOST_BITS`` bits, or at most ``limit`` bytes to be broadcast, nothing is filtered.
    ``row_key`` names columns of ``left`` that tell its rows apart, by which rows of hot
    keys are dealt.
    """
    found = measure(right)
    bits = filter_bits(found.rows)
    if not bits or found.bytes <= limit:
        return keyed_join(left, right, left_on, right_on, how, limit=limit, row_key=row_key, residual=residual)
    # A filter lets all rows of a key pass or none, so hot keys may be found without it.
    hot = hot_keys(left, left_on)
    marked = left.withColumn(_MAYBE, may_match(left_on, key_filter(right, right_on, bits), bits))
    joined = keyed_join(
        marked.where(_MAYBE).drop(_MAYBE), right, left_on, right_on, how,
        hot=hot, row_key=row_key, residual=residual, hint="merge",
    )
    if how != "left":
        return joined
    alone = marked.where(~F.col(_MAYBE)).drop(_MAYBE)
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return joined.unionByName(alone.select("*", *nulls))


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    left_at: str,
    right_at: str,
    width: int,
    *,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Pairs of equal keys whose ``right_at`` is after ``left_at`` by ``width`` at most.

    Positions are numbers. They are cut into bins as wide as the band: a partner lies in the
    same bin or the next, so each row of ``right`` is copied into two, and the join is one
    by key and bin, in which hot bins are salted. No row meets a whole group.
    """
    if width <= 0:
        raise ValueError(f"a band of width {width}")
    bin_of = lambda at: F.floor(F.col(at) / F.lit(width)).cast("bigint")
    binned = left.withColumn("_bin_left", bin_of(left_at))
    own = bin_of(right_at)
    copied = right.withColumn("_bin_right", F.explode(F.array(own, own - 1)))
    apart = F.col(right_at) - F.col(left_at)
    joined = keyed_join(
        binned, copied, [*left_on, "_bin_left"], [*right_on, "_bin_right"],
        row_key=row_key, residual=(apart > 0) & (apart <= width), hint="merge",
    )
    return joined.drop("_bin_left", "_bin_right")
