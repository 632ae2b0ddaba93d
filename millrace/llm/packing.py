"""Packing token sequences into windows by best-fit decreasing.

Documents are cut into full windows, which are sequences of their own, and a rest
shorter than a window. Best-fit decreasing needs only to know how many rests there
are of each length, at most ``window`` numbers however large the corpus is. It
runs on these counts: a segment tree over remaining capacities finds the tightest
open windows for a length, and all its pieces that fit the same kind of window are
placed at once. The result is a table of moves, from which every piece finds its
sequence and offset by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import map_blocks
from millrace.llm.vocabulary import word_ids
from millrace.scratch import fresh_path

WINDOW = 2048
END_OF_DOCUMENT = 1

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in (
            "start", "length", "ids_crc32", "doc_tokens", "block", "rank_in_block")],
    ]
)


class OpenWindows:
    """Ranges of window numbers by remaining capacity, under a segment tree.

    A leaf per capacity tells whether any window has it; an inner node whether any
    below does. The tightest fit for a length is the first set leaf at or after it.
    """

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.ranges: list[deque[tuple[int, int]]] = [deque() for _ in range(window + 1)]

    def _set(self, capacity: int, filled: bool) -> None:
        node = capacity + self.leaves
        self.any[node] = filled
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def put(self, capacity: int, first: int, count: int) -> None:
        self.ranges[capacity].append((first, count))
        if not self.any[capacity + self.leaves]:
            self._set(capacity, True)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        first, count = self.ranges[capacity].popleft()
        if count > most:
            self.ranges[capacity].appendleft((first + most, count - most))
            return first, most
        if not self.ranges[capacity]:
            self._set(capacity, False)
        return first, count

    def tightest(self, length: int) -> int | None:
        node = length + self.leaves
        if self.any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan_best_fit(counts: Mapping[int, int], window: int = WINDOW) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first window, offset), each up to the next rank.

    Equal pieces are placed together, windows of one capacity are alike, and each
    length splits two ranges at most, so there are at most about ``3 * window`` ranges.
    A window that is the tightest fit for a length stays so until it is too full
    for another piece, and so takes all it can before the next one does.
    """
    opened, free = 0, OpenWindows(window)
    moves: dict[int, np.ndarray] = {}
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, count, rows = 0, counts[length], []
        while rank < count:
            left = count - rank
            capacity = free.tightest(length)
            if capacity is None:
                capacity = window
                each = capacity // length
                first, taken = opened, -(-left // each)
                opened += taken
            else:
                each = capacity // length
                first, taken = free.take(capacity, -(-left // each))
            full = min(taken, left // each)
            if full:
                for layer in range(each):
                    rows.append((rank, first, window - capacity + layer * length))
                    rank += full
                free.put(capacity - each * length, first, full)
            if full < taken:  # one window more, for fewer pieces than it could take
                rest = left - full * each
                for layer in range(rest):
                    rows.append((rank, first + full, window - capacity + layer * length))
                    rank += 1
                free.put(capacity - rest * length, first + full, 1)
        moves[length] = np.array(rows, np.int64)
    return moves


def token_pieces(df: DataFrame, doc_id: str, text: str, vocabulary: str, window: int) -> DataFrame:
    """Windows and rests of every document, with checksums of their ids.

    ``block`` and ``rank_in_block`` number the pieces of one length within a task.
    """

    def start():
        vocabulary_ids = word_ids(vocabulary)
        block = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        end = np.array([END_OF_DOCUMENT], "<u4").tobytes()

        def compute(texts, ids):
            rows = []
            for key, joined in zip(ids, vocabulary_ids.of_texts(texts), strict=True):
                tokens = joined + end
                total = len(tokens) // 4
                for at in range(0, total, window):
                    piece = tokens[4 * at : 4 * (at + window)]
                    length = len(piece) // 4
                    rows.append((key, at, length, zlib.crc32(piece), total, block, int(seen[length])))
                    seen[length] += 1
            return tuple(zip(*rows, strict=True))

        return compute

    columns = [F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id")]
    return map_blocks(df.select(*columns), start, PIECES, remembers=vocabulary)


def _looked_up(moves: Mapping[int, np.ndarray], out: T.StructType):
    """Adds sequence and offset to pieces whose rank within their length is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                table = moves[int(value)]
                row = np.searchsorted(table[:, 0], rank[at], side="right") - 1
                sequence[at] = table[row, 1] + rank[at] - table[row, 0]
                offset[at] = table[row, 2]
            held = [batch.column(n) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*held, pa.array(sequence), pa.array(offset)], names=out.names)

    return run


def pack_documents(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    vocabulary: str,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: its place in its document and in a sequence of ``window`` ids.

    A null text counts as empty and is the end-of-document id alone. Null and
    repeated ids are packed like others, equal rows each for themselves. An empty
    table gives an empty result. Other columns are not looked at. Pieces without
    ids are written once to the shared scratch folder before they are counted.
    """
    path = fresh_path(df.sparkSession, "pieces")
    token_pieces(df, doc_id, text, vocabulary, window).write.parquet(path)
    pieces = df.sparkSession.read.schema(PIECES).parquet(path)
    blocks = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("pieces"))
    counts = blocks.groupBy("length").agg(F.sum("pieces").alias("pieces"))
    # One row per length: at most ``window`` rows, whatever the table.
    moves = plan_best_fit({r["length"]: r["pieces"] for r in counts.collect()}, window)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select(
        F.col("block").alias("_block"),
        F.col("length").alias("_length"),
        F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("_before"),
    )
    ranked = pieces.join(
        first, (F.col("block") == F.col("_block")) & (F.col("length") == F.col("_length"))
    ).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_before") + F.col("rank_in_block")).alias("rank"),
    )
    out = T.StructType(
        [T.StructField(n, T.LongType()) for n in (
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    )
    return ranked.mapInArrow(_looked_up(moves, out), out)
