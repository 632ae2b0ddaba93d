"""Benchmark passages in documents, found by spaced seeds that forgive substitutions.

A seed hashes the words at the set positions of a fixed mask and ignores the
others, so a passage with replaced words still shares seeds with its source. Seeds
of test items fill a bitmap of fixed size; documents are read once, and only the
stretches of words around positions that hit it go on. Those are joined with the
item seeds, and each alignment found is verified word by word.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns, map_blocks
from millrace.llm.words import Words, mix
from millrace.scratch import fresh_path

#: Positions that count, by the smallest item that a family is for. Whatever words of an
#: item are replaced, as long as it still counts, some mask of its family lies on
#: equal words only: 1 of 5 to 9 words, 2 of 10 to 14, and from 15 words on a fifth of any
#: stretch of 15 or more.
FAMILIES = {
    5: ("1111", "11011", "11101", "10111"),
    6: ("1111", "11011"),
    8: ("11111", "111011"),
    10: ("1111011", "11001111", "111010101", "110110011", "1011111"),
    15: (
        "111011100101", "110110011101", "101100111011", "111101010011",
        "111011011", "1101000001111", "1110001001011", "1001001110011", "1011100010101",
    ),
}
MASKS = tuple(dict.fromkeys(mask for family in FAMILIES.values() for mask in family))
SPAN = max(map(len, MASKS))
#: Words taken along before the first and behind the last hit of a stretch.
MARGIN = 64
#: Items of fewer words are no passages.
LEAST_ITEM_WORDS = min(FAMILIES)
#: An alignment counts with so many equal words, or 80 % of a shorter item's.
LEAST_EQUAL = 12
LEAST_SHARE = 0.8
_PERCENT = round(100 * LEAST_SHARE)
_MISMATCH = -3
BITMAP_BITS = 1 << 24
_U64 = np.uint64
_MASK_AT = {mask: [i for i, c in enumerate(mask) if c == "1"] for mask in MASKS}


def family(words: int) -> tuple[str, ...]:
    """The masks by which an item of so many words is sought."""
    return FAMILIES[max(n for n in FAMILIES if n <= words)] if words >= LEAST_ITEM_WORDS else ()


def seeds(hashes: np.ndarray, masks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All seeds by ``masks`` of a sequence of word hashes with their positions."""
    made, at = [], []
    for mask in masks:
        count = len(hashes) - len(mask) + 1
        if count <= 0:
            continue
        total = np.full(count, MASKS.index(mask) + 1, _U64)
        for i in _MASK_AT[mask]:
            total *= _U64(0x9FB21C651E98DF25)
            total += hashes[i : i + count]
        made.append(mix(total))
        at.append(np.arange(count))
    if not made:
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    return np.concatenate(made), np.concatenate(at)


def _bits(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    last = _U64(BITMAP_BITS - 1)
    return seed & last, (seed >> _U64(32)) & last


_LONGS = T.ArrayType(T.LongType())
_ITEMS = T.StructType([T.StructField("words", _LONGS), T.StructField("seeds", _LONGS), T.StructField("at", _LONGS)])


def _item_words(texts: Sequence[str | None]) -> tuple:
    block, rows = Words(texts, lower=True), []
    for i in range(len(texts)):
        hashes = block.hash[block.first[i] : block.first[i + 1]]
        made, at = seeds(hashes, family(len(hashes)))
        rows.append((hashes.view(np.int64), made.view(np.int64), at))
    return tuple(zip(*rows, strict=True))


def _bitmap(item_seeds: DataFrame) -> np.ndarray:
    """A bitmap of ``BITMAP_BITS`` bits in which each seed has set two."""
    bits = BITMAP_BITS
    number = F.explode(
        F.array(
            F.pmod(F.col("seed"), F.lit(bits)),
            F.pmod(F.shiftrightunsigned("seed", 32), F.lit(bits)),
        )
    ).alias("bit")
    words = item_seeds.select(number).groupBy(F.shiftright("bit", 6).alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT))) AS `set`")
    )
    packed = words.toPandas()  # at most BITMAP_BITS / 64 rows
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[packed["slot"].to_numpy(np.int64)] = packed["set"].to_numpy(np.int64)
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(bool)


_STRETCHES = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("words", _LONGS),
        T.StructField("seeds", _LONGS),
        T.StructField("at", _LONGS),
    ]
)


def text_key(hashes: np.ndarray) -> int:
    """A 64-bit number of a sequence of words."""
    order = np.arange(1, len(hashes) + 1, dtype=_U64)
    return int(np.bitwise_xor.reduce(mix(hashes + order * _U64(0xA0761D6478BD642F)), initial=0).view(np.int64))


def _stretches(bitmap, masks: Sequence[str]):
    """Finds the stretches of documents around bitmap hits."""

    def start():
        filled = bitmap.value

        def compute(texts, ids):
            block, rows = Words(texts, lower=True), []
            for i, doc_id in enumerate(ids):
                hashes = block.hash[block.first[i] : block.first[i + 1]]
                made, at = seeds(hashes, masks)
                one, two = _bits(made)
                hit = np.flatnonzero(filled[one])
                hit = hit[filled[two[hit]]]
                if not len(hit):
                    continue
                hit = hit[np.argsort(at[hit], kind="stable")]
                key = text_key(hashes)
                breaks = np.flatnonzero(np.diff(at[hit]) > MARGIN) + 1
                for group in np.split(hit, breaks):
                    first = max(0, int(at[group[0]]) - MARGIN)
                    last = int(at[group[-1]]) + SPAN + MARGIN
                    words = hashes[first:last].view(np.int64)
                    rows.append((key, doc_id, first, words, made[group].view(np.int64), at[group]))
            return tuple(zip(*rows, strict=True)) if rows else None

        return compute

    return start


def _densest(equal: np.ndarray, mismatch: int) -> tuple[int, int]:
    """The stretch with the largest sum, where equal words count 1, others ``mismatch``."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, mismatch))])
    lowest = np.minimum.accumulate(total)
    end = int(np.argmax(total - lowest))
    return int(np.argmin(total[: end + 1])), end


def _longest(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with the most equal words of those with a share of ``LEAST_SHARE``."""
    # A stretch has that share if these numbers do not fall from its start to its end.
    each = np.where(equal, 100 - _PERCENT, -_PERCENT)
    total = np.concatenate([[0], np.cumsum(each)])
    lowest = np.minimum.accumulate(total)
    first = np.searchsorted(-lowest, -total)
    words = np.concatenate([[0], np.cumsum(equal)])
    end = int(np.argmax(words - words[first]))
    return int(first[end]), end


def best_alignment(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Start and end in ``text`` of the passage along one diagonal, and its equal words.

    ``item[i]`` lies on ``text[i + shift]``. The whole item is a passage if
    ``LEAST_SHARE`` of its words are equal. Else it is the best run, where equal words
    count 1, others ``_MISMATCH``, or, if that has too few equal words, the longest
    stretch with that share. A passage begins and ends with an equal word.
    """
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    if high <= low:
        return None
    equal = item[low:high] == text[low + shift : high + shift]
    least = min(LEAST_EQUAL, -(-_PERCENT * len(item) // 100))
    if int(equal.sum()) < least:
        return None
    stretches = [(0, len(equal))] if 100 * int(equal.sum()) >= _PERCENT * len(item) else []
    for start, end in stretches or (_densest(equal, _MISMATCH), _longest(equal)):
        inside = start + np.flatnonzero(equal[start:end])
        if len(inside) < least:
            continue
        start, end = int(inside[0]), int(inside[-1]) + 1
        if 100 * len(inside) >= _PERCENT * (end - start):
            return low + shift + start, low + shift + end, len(inside)
    return None


_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("start_word", "end_word", "equal_words")])


def _verify(texts, items, shifts) -> tuple:
    rows = []
    for words, item, shift in zip(texts, items, shifts, strict=True):
        found = best_alignment(np.array(words, np.int64), np.array(item, np.int64), shift)
        rows.append(found or (None, None, None))
    return tuple(zip(*rows, strict=True))


def contaminated_passages(
    df: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Passages of ``benchmark`` items in the texts of ``df``.

    One row per document and item: ``doc_id``, ``item_id``, the first and last
    word of the longest verified passage (end exclusive, words counted from 0),
    its equal words, and ``text_key`` of the document's words. Words are compared
    without regard to ASCII case. Rows with equal id and words are reported once;
    null ids are kept as null; null, empty and very short texts and items match
    nothing; empty tables give an empty result. Other columns are not looked at.
    """
    spark = df.sparkSession
    item_path, seed_name = fresh_path(spark, "items"), "seed"
    items = benchmark.select(F.col(f"`{item_text}`").alias("text"), F.col(f"`{item_id}`").alias("item_id"))
    append_columns(items.distinct(), ["text"], _item_words, _ITEMS, ["item_id"]).withColumn(
        "_item", F.monotonically_increasing_id()
    ).write.parquet(item_path)
    items = spark.read.parquet(item_path)
    item_seeds = items.select(
        "_item", F.explode(F.arrays_zip("seeds", "at")).alias("s")
    ).select("_item", F.col("s.seeds").alias(seed_name), F.col("s.at").alias("item_at"))
    size = F.least(F.size("words"), F.lit(max(FAMILIES)))
    counted = items.select(size.alias("n")).distinct().collect()  # at most so many numbers
    sought = {mask for r in counted for mask in family(r["n"])}
    masks = [mask for mask in MASKS if mask in sought]
    bitmap = spark.sparkContext.broadcast(_bitmap(item_seeds))
    documents = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"))
    path = fresh_path(spark, "stretches")
    map_blocks(documents, _stretches(bitmap, masks), _STRETCHES).distinct().withColumn(
        "_stretch", F.monotonically_increasing_id()
    ).write.parquet(path)
    stretches = spark.read.parquet(path)
    hits = stretches.select(
        "_stretch", "first_word", F.explode(F.arrays_zip("seeds", "at")).alias("s")
    ).select("_stretch", "first_word", F.col("s.seeds").alias("doc_seed"), F.col("s.at").alias("doc_at"))
    # Distinct alignments of a stretch and an item, however many seeds they share.
    aligned = (
        hits.join(item_seeds, F.col("doc_seed") == F.col(seed_name))
        .select("_stretch", "_item", (F.col("doc_at") - F.col("item_at") - F.col("first_word")).alias("shift"))
        .distinct()
    )
    pairs = aligned.join(
        stretches.select(F.col("_stretch").alias("_s"), "key", "doc_id", "first_word", "words"),
        F.col("_stretch") == F.col("_s"),
    ).join(
        items.select(F.col("_item").alias("_i"), "item_id", F.col("words").alias("item_words")),
        F.col("_item") == F.col("_i"),
    )
    verified = append_columns(
        pairs, ["words", "item_words", "shift"], _verify, _FOUND, ["key", "doc_id", "item_id", "first_word"]
    ).where("equal_words IS NOT NULL")
    longest = F.max(
        F.struct(
            "equal_words",
            (F.col("first_word") + F.col("start_word")).alias("start_word"),
            (F.col("first_word") + F.col("end_word")).alias("end_word"),
        )
    ).alias("best")
    return verified.groupBy("doc_id", "key", "item_id").agg(longest).select(
        "doc_id", "item_id", F.col("best.start_word").alias("start_word"),
        F.col("best.end_word").alias("end_word"), F.col("best.equal_words").alias("equal_words"),
        F.col("key").alias("text_key"),
    )


_KEY = T.StructType([T.StructField("_text_key", T.LongType())])


def _keys(texts: Sequence[str | None]) -> tuple:
    block = Words(texts, lower=True)
    return ([text_key(block.hash[a:b]) for a, b in zip(block.first[:-1], block.first[1:], strict=True)],)


def without_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without the documents that hold a passage of ``benchmark``."""
    found = contaminated_passages(df.select(F.lit(None).cast("bigint").alias("doc_id"), text), benchmark)
    keys = found.select(F.col("text_key").alias("_found_key")).distinct()
    order = df.columns
    keyed = append_columns(df, [text], _keys, _KEY)
    clean = keyed.join(keys, F.col("_text_key") == F.col("_found_key"), "left_anti")
    return clean.select(*[f"`{c}`" for c in order])
