"""Window operators that do not gather a hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import check_repeatable, keyed_join
from millrace.operators.sizing import HotKeys, hot_keys


def window_max(
    df: DataFrame,
    partition_by: Sequence[str],
    value: str,
    name: str,
    *,
    hot: HotKeys | None = None,
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Every row with the largest ``value`` of its group.

    The maxima are aggregated map-side and joined back, so that no group has to
    meet in one task; rows of hot groups are salted for that join.
    """
    if hot is None:
        check_repeatable(df, row_key)
        hot = hot_keys(df, partition_by)
    group = [f"_group_{i}" for i in range(len(partition_by))]
    maxima = df.groupBy(*[F.col(k).alias(g) for k, g in zip(partition_by, group, strict=True)])
    joined = keyed_join(
        df, maxima.agg(F.max(value).alias(name)), partition_by, group, "left",
        hot=hot, row_key=row_key, null_safe=True, hint="merge",
    )
    return joined.drop(*group)


def nth_in_group(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    n: int,
    name: str = "rn",
) -> DataFrame:
    """The ``n``-th row of each group; ``order_by`` must leave no ties.

    The filter on the row number lets every map task keep only its first ``n``
    rows per group before the shuffle (``WindowGroupLimit``, for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``).
    """
    ordered = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(ordered)).where(F.col(name) == n)
