"""Writers for file formats."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

# Parquet codecs by the names callers know.
CODECS = ("snappy", "gzip", "zstd", "none")
STAMP = "extraction_timestamp"


def parquet_codec(name: str) -> str:
    """A codec Spark can write; unknown names fall back to snappy."""
    codec = name.lower()
    if codec == "lzo":
        raise ValueError(f"lzo needs a codec that Spark does not ship; use one of {CODECS}")
    if codec not in CODECS:
        logger.warning("unknown compression %s, using snappy", name)
        return "snappy"
    return codec


def stamp(df: DataFrame, run_time: datetime) -> DataFrame:
    """Add the run's time as text, equal on all rows."""
    return df.withColumn(STAMP, F.lit(run_time.strftime("%Y-%m-%d %H:%M:%S")))


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    codec: str = "snappy",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> int:
    """Write and return the number of rows, counted by the write itself.

    With ``partition_by`` rows are first gathered by those columns, so that each
    folder gets few files; adaptive execution divides folders that are too big
    for one task.
    """
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = counted.hint("rebalance", *partition_by)
    writer = counted.write.mode(mode).option("compression", parquet_codec(codec))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return rows.get["rows"]


def write_single_file(
    df: DataFrame, path: str, fmt: str = "csv", *, mode: str = "error", **options
) -> None:
    """Write a result as one file if it is small, else as few as adaptive execution makes.

    The input is computed once, and no task gets more than a partition's worth.
    """
    df.hint("rebalance").write.mode(mode).format(fmt).options(**options).save(path)


def write_keyed_extracts(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    path: str,
    *,
    fmt: str = "csv",
    mode: str = "overwrite",
    **options,
) -> None:
    """One folder ``extract_key=<value>`` per wanted value, from a single scan.

    Case is ignored. The files keep the key as it was.
    """
    wanted = [v.lower() for v in values]
    chosen = df.where(F.lower(key).isin(*wanted)).withColumn("extract_key", F.lower(key))
    (
        chosen.hint("rebalance", "extract_key")
        .write.mode(mode).format(fmt).options(**options)
        .partitionBy("extract_key").save(path)
    )
