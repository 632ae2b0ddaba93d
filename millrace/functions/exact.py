"""Sums that do not depend on the order of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 2
# What a price is cast to where it is shown rather than summed.
MONEY = "decimal(18,2)"
_DIGITS = 28
# Whole doubles are exact up to this number.
_WHOLE = 2**53
_LOW_BITS = 26


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def exact(column: str | Column, scale: int = SCALE) -> Column:
    """A number with ``scale`` decimals; one that has more, or is too large, raises."""
    value = _column(column)
    kind = f"decimal({_DIGITS},{scale})"
    # try_cast gives null where the digits before the point do not fit.
    rounded = value.try_cast(kind)
    lossless = value.isNull() | F.coalesce(rounded.cast("double") == value.cast("double"), F.lit(False))
    message = F.concat(F.lit(f"more than {scale} decimals, or too large: "), value.cast("string"))
    return F.when(lossless, rounded).otherwise(F.raise_error(message).cast(kind))


def _units(column: str | Column, scale: int) -> Column:
    """A number as whole units of its last decimal; one that is none, or too large, raises."""
    value = _column(column).cast("double")
    units = F.rint(value * 10.0**scale)
    whole = (units / 10.0**scale == value) & (F.abs(units) < float(_WHOLE))
    message = F.concat(F.lit(f"more than {scale} decimals, or too large: "), value.cast("string"))
    return F.when(whole | value.isNull(), units.cast("bigint")).otherwise(F.raise_error(message).cast("bigint"))


def exact_sum(column: str | Column, scale: int = SCALE) -> Column:
    """Sum of numbers that have ``scale`` decimals.

    Units are summed as two whole numbers, the upper and the lower bits, which do not
    overflow for as many rows as there can be; the decimal is made once per group.
    """
    units = _units(column, scale)
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**_LOW_BITS - 1))).cast("decimal(19,0)")
    total = (high * F.lit(2**_LOW_BITS).cast("decimal(9,0)") + low).cast("decimal(30,0)")
    return (total * F.lit(f"1e-{scale}").cast(f"decimal({scale + 1},{scale})")).cast("double")


def exact_avg(column: str | Column, scale: int = SCALE) -> Column:
    return exact_sum(column, scale) / F.count(_column(column))


# -- numbers of any scale --------------------------------------------------------------
#: Powers of two in one bin. A double is then a whole number below 2**59 times its bin's.
BIN_BITS = 4
_HALF = 2.0**30
# Doubles below this are brought up by _LIFT first, as the powers that divide them, and
# what is left of the result, would be too small to be exact.
_TINY, _LIFT, _LIFT_POWER = 2.0**-800, 2.0**600, 600
_WIDEST = 55


def _bins(value: Column) -> tuple[Column, Column, Column]:
    """Bin of a finite double, and the upper and lower half of its whole number there.

    The logarithm may be off by one at powers of two, hence one more bit than the 53 that a
    double has. Every step is exact: scaling by powers of two, cutting, subtracting.
    """
    tiny = F.abs(value) < _TINY
    lifted = F.when(tiny, value * _LIFT).otherwise(value)
    size = F.abs(lifted)
    power = F.when(size == 0, 0).otherwise(F.floor(F.log2(size)) - (_WIDEST - 1))
    bin_ = F.floor(power / BIN_BITS).cast("int")
    whole = lifted / F.pow(F.lit(2.0), bin_ * BIN_BITS)
    high = F.floor(whole / _HALF)
    low = whole - high * _HALF
    return bin_ - F.when(tiny, _LIFT_POWER // BIN_BITS).otherwise(0), high, low.cast("bigint")


# Four parts of less than 32 bits a bin, from the largest bin on; what each addition rounds
# off is added at the end. Powers are taken in steps, none of which is out of range.
_ADD = f"""
    aggregate(
      flatten(transform(
        array_sort(bins, (a, b) -> b.bin - a.bin),
        x -> transform(
          array(shiftright(x.high, 31), x.high & 2147483647, shiftright(x.low, 31), x.low & 2147483647),
          (part, i) -> part * element_at(array({2.0**61}D, {2.0**30}D, {2.0**31}D, 1D), i + 1)
            * power(2D, greatest(x.bin * {BIN_BITS}, -700)) * power(2D, least(x.bin * {BIN_BITS} + 700, 0))))),
      named_struct('sum', 0D, 'rest', 0D),
      (acc, x) -> named_struct(
        'sum', acc.sum + x,
        'rest', acc.rest + ((acc.sum - ((acc.sum + x) - ((acc.sum + x) - acc.sum)))
                            + (x - ((acc.sum + x) - acc.sum)))),
      acc -> if(isnan(acc.rest), acc.sum, acc.sum + acc.rest))"""


def binned_sums(df: DataFrame, keys: Sequence[str], column: str, total: str, count: str) -> DataFrame:
    """Per key the sum and number of the values of a double column, whatever their scale.

    A first aggregation, map-side, adds whole numbers per key and exponent bin, of which
    doubles have some 500 and most columns a few. A second adds the bins of a key, from the
    largest to the smallest and carrying what each addition rounds off. Neither depends on
    the order or the placement of rows, so the same rows give the same bits, as a rule those
    of the true sum rounded once. Infinities and NaN give what adding them gives, and a sum
    beyond the largest double is infinite; a key without values has a null sum.
    """
    value = F.col(column).cast("double")
    finite = F.abs(value) < float("inf")
    bin_, high, low = _bins(value)
    names = [f"_key_{i}" for i in range(len(keys))]
    rows = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.when(finite, bin_).alias("bin"),
        F.when(finite, high).alias("high"),
        F.when(finite, low).alias("low"),
        F.when(~finite, value).alias("odd"),
        value.isNotNull().cast("bigint").alias("n"),
    )
    halves = rows.groupBy(*names, "bin").agg(*[F.sum(c).alias(c) for c in ("high", "low", "odd", "n")])
    bins = F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "high", "low")))
    whole = halves.groupBy(*names).agg(bins.alias("bins"), F.sum("odd").alias("odd"), F.sum("n").alias("n"))
    added = F.when(F.size("bins") > 0, F.expr(_ADD))
    result = F.when(F.col("odd").isNotNull(), F.col("odd")).otherwise(added)
    back = [F.col(n).alias(k) for k, n in zip(keys, names, strict=True)]
    return whole.select(*back, result.alias(total), F.col("n").alias(count))
