"""Reuse of a filtered subset."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Keep ``df`` from its first action on; lost blocks are computed again.

    Frames derived from it use the cache until the caller calls ``unpersist`` on the
    result, or clears the session's cache.
    """
    return df.persist(level)


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df`` cached for the length of a ``with`` block."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
