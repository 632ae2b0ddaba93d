"""Passages that repeat across documents, by content-defined chunking.

A gear rolling hash over the bytes of a text cuts it wherever the hash of the last
``REACH`` bytes has ``CUT_BITS`` zero bits, so cuts depend on nearby bytes alone and
fall alike in every copy of a passage, whatever stands before it. A cut closely
behind another is left out by a rule that is local too. Chunks are deduplicated by
digest: those of more than one document are found in a first pass, and a second
puts neighbouring ones together into passages.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns, map_blocks
from millrace.llm.words import mix
from millrace.scratch import fresh_path

#: A cut every 32 bytes on average, before those too close are left out.
CUT_BITS = 5
REACH = 16
LEAST_CHUNK = 8
LONG_CHUNK = 256
REACH_BACK = 48
#: Neighbouring repeated chunks count as a passage from so many bytes on.
LEAST_PASSAGE = 100
#: Bits that mark repeated digests; more of them only save shuffling.
_MARKED_BITS = 1 << 26
_U64 = np.uint64
_GEAR = (mix(np.arange(1, 257, dtype=_U64)) >> _U64(48)).astype(np.uint16)
_BASE = 0x9E3779B97F4A7C15
_NUMBER = mix(np.arange(1001, 1257, dtype=_U64))
_powers = [np.ones(1, _U64), np.ones(1, _U64)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes, the text's own end included.

    Text that repeats a few bytes over and over may have no cut for long. Stretches
    of more than ``LONG_CHUNK`` bytes are therefore cut at the smallest hash within
    ``REACH_BACK`` bytes, which such text has in each of its repetitions. Cuts move on to
    the next start of a character.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    gear, width = _GEAR[data], 1
    while width < REACH:  # the sum over 2 * width bytes from two over width
        shifted = np.zeros(size, np.uint16)
        shifted[width:] = gear[:-width] << np.uint16(width)
        gear = gear + shifted
        width *= 2
    at = np.flatnonzero((gear >> np.uint16(16 - CUT_BITS)) == 0) + 1
    if len(at):
        apart = np.concatenate([[True], np.diff(at) >= LEAST_CHUNK])
        at = at[apart]
    ends = at if len(at) and at[-1] == size else np.append(at, size)
    more = [
        _smallest_within(gear, start, end)
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)
        if end - start > LONG_CHUNK
    ]
    if more:
        at = np.unique(np.concatenate([at, *more]))
    if len(at):
        inside = (data & 0xC0) == 0x80
        for _ in range(3):
            at = at + ((at < size) & inside[np.minimum(at, size - 1)])
        at = np.unique(at)
    if not len(at) or at[-1] < size:
        at = np.append(at, size)
    return at


def _smallest_within(gear: np.ndarray, start: int, end: int) -> np.ndarray:
    """Cuts of a long stretch, ``LEAST_CHUNK`` bytes or more apart."""
    part = gear[start:end]
    least = np.lib.stride_tricks.sliding_window_view(part, REACH_BACK).min(axis=1)
    places = start + REACH_BACK + np.flatnonzero(part[REACH_BACK - 1 :] == least)
    kept, last = [], start
    for place in places.tolist():
        if place - last >= LEAST_CHUNK:
            kept.append(place)
            last = place
    return np.array(kept, np.int64)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, _U64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers[0], _powers[1]


def digests(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each chunk."""
    powers, inverse = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U64)
    np.cumsum(_NUMBER[data] * powers[: len(data)], out=sums[1:])
    starts = np.concatenate([[0], ends[:-1]])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(raw + (ends - starts).astype(_U64) * _U64(_BASE)).view(np.int64)


def _key(doc_id: int | None, found: np.ndarray) -> int:
    """The document's id, or a number of its text where that is null."""
    if doc_id is not None:
        return doc_id
    total = np.bitwise_xor.reduce(mix(found.view(_U64)), initial=_U64(len(found)))
    return -int(total >> _U64(2)) - 1


def _chunks(texts: Sequence[str | None], ids: Sequence[int | None], numbers: Sequence[int] | None = None):
    for text, doc_id, row in zip(texts, ids, numbers or [0] * len(texts), strict=True):
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        ends = cuts(data)
        if len(ends):
            found = digests(data, ends)
            yield doc_id, _key(doc_id, found), data, ends, found, row


_DIGESTS = T.StructType([T.StructField(n, T.LongType()) for n in ("digest", "key")])


def _all_digests():
    def compute(texts, ids):
        made, keys = [], []
        for _, key, _, _, found, _ in _chunks(texts, ids):
            once = np.unique(found)
            made.append(once)
            keys.append(np.full(len(once), key, np.int64))
        return (np.concatenate(made), np.concatenate(keys)) if made else None

    return compute


_PLACES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "key", "row", "number", "start", "end", "bytes", "digest")]
)


def _marked_places(marked):
    """The chunks whose digest is marked, with their place in code points."""

    def start():
        bits = marked.value

        def compute(texts, ids, numbers):
            rows = []
            for doc_id, key, data, ends, found, row in _chunks(texts, ids, numbers):
                slot = (found.view(_U64) % _U64(_MARKED_BITS)).astype(np.int64)
                hit = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                if not len(hit):
                    continue
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                starts = np.concatenate([[0], ends[:-1]])
                rows.append((
                    [doc_id] * len(hit), np.full(len(hit), key, np.int64), np.full(len(hit), row, np.int64), hit,
                    points[starts[hit]], points[ends[hit]], (ends - starts)[hit], found[hit],
                ))
            if not rows:
                return None
            columns = list(zip(*rows, strict=True))
            ids_out = [i for part in columns[0] for i in part]
            return (ids_out, *[np.concatenate(c) for c in columns[1:]])

        return compute

    return start


def _bitmap(repeated: DataFrame) -> np.ndarray:
    """A bitmap of ``_MARKED_BITS`` bits with those of the digests set."""
    slot = F.pmod(F.col("digest"), F.lit(_MARKED_BITS)).alias("slot")
    parts = repeated.select(slot).groupBy(F.shiftright("slot", 15).alias("part")).agg(
        F.collect_set(F.expr("CAST(slot & 32767 AS SMALLINT)")).alias("slots")
    )
    bits = np.zeros(_MARKED_BITS // 8, np.uint8)
    for row in parts.toLocalIterator():  # at most 2048 rows of 32,768 numbers each
        part = np.zeros(1 << 15, bool)
        part[np.array(row["slots"], np.int64)] = True
        first = row["part"] << 12
        bits[first : first + (1 << 12)] = np.packbits(part, bitorder="little")
    return bits


def _row_number(text: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.col(f"`{text}`"))


def repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages of ``LEAST_PASSAGE`` bytes or more whose chunks other documents hold too.

    One row per passage: ``doc_id``, ``start`` and ``end`` in code points, ``n_bytes``,
    ``n_chunks``, and ``first_doc_id``, the smallest id of a document that holds a
    chunk of it; the passage there is the one to keep (``is_first``). A passage's
    edges lie on cuts, so it may start and end a chunk inside the repeated text.

    Rows with one id count as one document, of which each text has passages of its own,
    equal rows those of one; a row without an id is known by its
    text, and stands in ``first_doc_id`` as a negative number of it. Null and empty
    texts have no passages; an empty table gives an empty result. Other columns are
    not looked at.
    """
    return _passages(df, doc_id, text).drop("row")


def _passages(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``repeated_passages`` with the number of the row's text."""
    spark = df.sparkSession
    documents = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"))
    numbered = documents.select("text", "doc_id", _row_number("text").alias("row"))
    path = fresh_path(spark, "digests")
    # Sums per digest are partial before the shuffle, so frequent chunks do no harm.
    (
        map_blocks(documents, _all_digests, _DIGESTS)
        .groupBy("digest")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"))
        .where("least <> most")
        .select("digest", "least")
        .write.parquet(path)
    )
    repeated = spark.read.parquet(path)
    marked = spark.sparkContext.broadcast(_bitmap(repeated))
    places = map_blocks(numbered, _marked_places(marked), _PLACES).distinct()
    held = places.join(repeated.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"))
    # Neighbours share the difference of their number and their rank: one passage each.
    ranked = held.withColumn(
        "_passage",
        F.col("number") - F.row_number().over(Window.partitionBy("key", "row").orderBy("number")),
    )
    passages = ranked.groupBy("key", "doc_id", "row", "_passage").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum("bytes").alias("n_bytes"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.min("least").alias("_first"),
    )
    return passages.where(F.col("n_bytes") >= LEAST_PASSAGE).select(
        "doc_id", "start", "end", "n_bytes", "n_chunks",
        F.col("_first").alias("first_doc_id"),
        (F.col("key") == F.col("_first")).alias("is_first"),
        "row",
    )


_TEXT = T.StructType([T.StructField("left_text", T.StringType())])


def _cut_out(texts, starts, ends) -> tuple:
    left = []
    for text, begins, finishes in zip(texts, starts, ends, strict=True):
        parts, at = [], 0
        for start, end in sorted(zip(begins or [], finishes or [], strict=True)):
            parts.append(text[at:start])
            at = max(at, end)
        left.append(text if not parts else "".join([*parts, text[at:]]))
    return (left,)


def without_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with every repeated passage cut out but in its first document.

    Rows without an id keep their texts. Other columns stay, whatever their names.
    """
    found = _passages(df, doc_id, text).where("NOT is_first AND doc_id IS NOT NULL")
    spans = found.groupBy("doc_id", F.col("row").alias("number")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    rows = df.select(
        F.struct("*").alias("row"),
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        _row_number(text).alias("number"),
    )
    joined = rows.join(spans, ["doc_id", "number"], "left")
    cut = append_columns(joined, ["text", "starts", "ends"], _cut_out, _TEXT, ["row"])
    return cut.select(
        *[F.col("left_text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns]
    )
