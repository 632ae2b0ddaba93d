"""Running a function of a few columns over whole tables in Arrow batches.

Batches are cut so that the text worked on at once stays near ``BLOCK_BYTES``
(one longer text is a block of its own), which bounds the memory of a task.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 1_000_000

_ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(),
    T.BinaryType(): pa.binary(),
    T.ArrayType(T.LongType()): pa.list_(pa.int64()),
    T.ArrayType(T.StringType()): pa.list_(pa.string()),
}


def arrow_types(fields: T.StructType) -> list[pa.DataType]:
    return [_ARROW[f.dataType] for f in fields]


_ROOT = str(Path(__file__).resolve().parents[2])


_remembered: dict[str, Any] = {}


def remembered(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept by this worker process for the next tasks.

    One thing is kept at a time, and a task that asks for none lets go of it, so
    a worker that serves several operators in turn does not hold all their caches.
    """
    if name not in _remembered:
        _remembered.clear()
        _remembered[name] = make()
    return _remembered[name]


def _forget(but: str | None) -> None:
    if _remembered and but not in _remembered:
        _remembered.clear()
        gc.collect()


def importable(df: DataFrame) -> None:
    """Lets Python workers on this machine import this package from where it lies.

    Workers elsewhere get it as usual, installed or by ``--py-files``.
    """
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def blocks(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose values in ``column`` come to about ``BLOCK_BYTES``."""
    if batch.nbytes <= BLOCK_BYTES:
        if batch.num_rows:
            yield batch
        return
    values = batch.column(column)
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    else:
        sizes = np.full(batch.num_rows, batch.nbytes // batch.num_rows)
    number = (np.cumsum(sizes, dtype=np.int64) - sizes) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for start, end in pairwise(cuts):
        yield batch.slice(start, end - start)


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    compute: Callable[..., Sequence],
    fields: T.StructType,
    keep: Sequence[str] | None = None,
    remembers: str | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with columns computed from ``inputs``.

    ``compute`` takes one list per input, texts first, and returns one sequence
    per field. A column of ``df`` that has the name of a new one is replaced.
    ``remembers`` names what the function keeps by ``remembered``.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    needed = [*kept, *[c for c in inputs if c not in kept]]
    df = df.select(*[f"`{c}`" for c in needed])
    out = T.StructType([*[df.schema[c] for c in kept], *fields])
    types = arrow_types(fields)
    at = [needed.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget(remembers)
        for batch in batches:
            for block in blocks(batch, at[0]):
                made = compute(*[block.column(i).to_pylist() for i in at])
                arrays = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
                held = [block.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*held, *arrays], names=out.names)

    importable(df)
    return df.mapInArrow(run, out)


def map_blocks(
    df: DataFrame,
    start: Callable[[], Callable[..., Sequence | None]],
    fields: T.StructType,
    end: bool = False,
    remembers: str | None = None,
) -> DataFrame:
    """Rows that a function makes of each block of the columns of ``df``, texts first.

    ``start`` is called once per task and returns that function, which takes one
    list per column and returns one sequence per field. If ``end``, it is called
    without columns at the end of the task for what it still holds.
    """
    types = arrow_types(fields)

    def batch_of(made: Sequence) -> pa.RecordBatch:
        arrays = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=fields.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget(remembers)
        compute = start()
        for batch in batches:
            for block in blocks(batch, 0):
                made = compute(*[c.to_pylist() for c in block.columns])
                if made is not None and len(made[0]):
                    yield batch_of(made)
        if end:
            made = compute()
            if made is not None and len(made[0]):
                yield batch_of(made)

    importable(df)
    return df.mapInArrow(run, fields)


def smallest(df: DataFrame, number: str, count: int) -> DataFrame:
    """``count`` rows of ``df`` with the smallest numbers, for a bounded sample.

    Tasks send numbers only; the rows are fetched once the bound is known.
    """
    bound = df.select(number).orderBy(number).limit(count).agg(F.max(number)).first()[0]
    return df.where(F.col(number) <= F.lit(bound)).limit(count)
