"""Reproducible shuffling into shards, in plain DataFrame expressions.

Every row gets a global number that depends on the rows alone: rows are ordered by
a checksum of their id, text checksum and size, then by these three. A Feistel
network over pairs of digits permutes the numbers 0 to n - 1; positions beyond
them are walked along their cycle until they fall inside. The permuted position
gives shard (remainder) and slot (quotient), so both can be computed for any row,
counts differ by one at most, and slots have no gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the checksum in which rows are numbered apart from each other.
RANGES = 4096
#: Copies of a row that are made from one record at most.
COPIES = 4096
_PRIME = 2_147_483_647
_FACTOR = 1_103_515_245
_SECOND = 48_271
#: One number per round; any would do, and a user may give others as a seed.
ROUND_KEYS = (101_027, 20_483_111, 777_001_583, 1_500_450_271, 31_337_003, 998_244_353)


def _round(value: Column, key: Column) -> Column:
    mixed = (value * _FACTOR + key) % _PRIME
    return ((mixed * (mixed + 1)) % _PRIME * _SECOND + key) % _PRIME


def _network(number: Column, side: Column, keys: tuple[int, ...]) -> Column:
    """One pass: a bijection of the numbers below ``side * side``."""

    def turn(halves: Column, key: Column) -> Column:
        return F.struct(
            halves["right"].alias("left"),
            ((halves["left"] + _round(halves["right"], key)) % side).alias("right"),
        )

    start = F.struct(
        ((number - number % side) / side).cast("bigint").alias("left"), (number % side).alias("right")
    )
    return F.aggregate(
        F.array(*[F.lit(k).cast("bigint") for k in keys]),
        start,
        turn,
        lambda halves: halves["left"] * side + halves["right"],
    )


def permuted(number: Column, rows: Column, side: Column, keys: tuple[int, ...] = ROUND_KEYS) -> Column:
    """Where ``number`` goes among ``rows`` positions; ``side`` is the least square's.

    At most ``side**2 - rows`` numbers lie outside, and a walk meets none twice, so
    the walk below always ends inside. It is rare: the network's first result is
    inside for all but about ``2 / side`` of the numbers.
    """
    first = _network(number, side, keys)

    def walk(start: Column) -> Column:
        # As long as the longest possible walk; it stands still once inside.
        steps = F.sequence(F.lit(1).cast("bigint"), side * side - rows + F.least(start, F.lit(1)))
        return F.aggregate(
            steps, start, lambda at, _: F.when(at < rows, at).otherwise(_network(at, side, keys))
        )

    # A one-element array holds the first result, so that it is computed once.
    return F.transform(
        F.array(first), lambda at: F.when(at < rows, at).otherwise(walk(at))
    ).getItem(0)


def feistel_shards(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8
) -> DataFrame:
    """Shard and slot of every row of ``df`` under the law ``rows``.

    A null text has no bytes (size 1, checksum 0); null ids come among the others
    by the checksum of the word null; equal rows get different positions; an empty
    table gives an empty result. Other columns of ``df`` are not looked at.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_crc32", "size")
    columns = ["doc_id", "text_crc32", "size"]
    # Equal rows are counted before the shuffle, so no group of them is gathered.
    counted = (
        rows.withColumn("_order", F.crc32(named))
        .groupBy("_order", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_range", F.floor(F.col("_order") / ((1 << 32) // RANGES)).cast("int"))
    )
    before = Window.partitionBy("_range").orderBy(
        "_order", *[F.col(c).asc_nulls_first() for c in columns]
    ).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    # At most RANGES rows, whatever the table: small enough for one task and a broadcast.
    totals = counted.groupBy("_range").agg(F.sum("_copies").alias("_rows"))
    running = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        F.col("_range").alias("_offset_range"),
        F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(whole).alias("_n"),
    )
    numbered = placed.join(F.broadcast(offsets), F.col("_range").eqNullSafe(F.col("_offset_range")))
    root = F.ceil(F.sqrt(F.col("_n").cast("double"))).cast("bigint")
    numbered = numbered.select(
        *columns, "_copies", "_n", (F.col("_offset") + F.col("_before")).alias("_first"),
        F.when(root * root < F.col("_n"), root + 1).otherwise(root).alias("_side"),
    )
    # Many equal rows are made in several records, dealt over the tasks by number.
    parts = numbered.withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPIES).cast("bigint")))
    ).repartition(F.col("_first") + F.col("_part"))
    last = F.least(F.col("_part") + COPIES, F.col("_copies")) - 1
    each = parts.withColumn("_copy", F.explode(F.sequence("_part", last)))
    each = each.withColumn("_number", F.col("_first") + F.col("_copy"))
    position = permuted(F.col("_number"), F.col("_n"), F.col("_side"))
    return each.withColumn("_position", position).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("_position") % shards).cast("int").alias("shard"),
        ((F.col("_position") - F.col("_position") % shards) / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
