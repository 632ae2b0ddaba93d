"""Exact near-duplicate groups by Jaccard similarity of word shingles.

Documents with equal shingle sets form a class. Classes are joined on the prefixes
of their sets: the rarest shingles, by a frequency sketch of fixed size over all
documents, so that a shared passage seldom brings unlike documents together.
Set relations then save most of the work (skipping on two levels):

* An index list holds the classes with one prefix shingle, by set size. It is read
  in blocks that know their smallest position; a block whose best entry could not
  reach the wanted overlap is skipped as a whole.
* Each class is first compared with one pivot, the class it shares most lists with.
  The answers of a pivot are passed on: classes linked to it are connected and
  need not be compared with each other, and by the triangle inequality of the
  Jaccard distance a class can be ruled out for another with the same pivot.

Only pairs that neither relation settles are verified, on the whole sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns, importable, map_blocks
from millrace.llm.components import connected_components
from millrace.llm.words import Words, mix, window_hashes
from millrace.scratch import fresh_path

SHINGLE_WORDS = 5
PERCENT = 80
#: Counters of the frequency sketch; more of them only make prefixes rarer.
MOST_COUNTERS = 1 << 22
_LEAST_COUNTERS = 1 << 16
_SLICE = 4096
#: Bits that mark the classes whose sets are asked for; more only save shuffling.
_MARKED_BITS = 1 << 25
_BLOCK = 64
_U64 = np.uint64


def shingles(hashes: np.ndarray) -> np.ndarray:
    """The sorted distinct shingles of a sequence of word hashes."""
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(SHINGLE_WORDS, len(hashes))))


def class_of(found: np.ndarray) -> int:
    """A 64-bit number of a set."""
    total = np.bitwise_xor.reduce(mix(found + _U64(0x632BE59BD9B4E019)), initial=_U64(len(found)))
    return int(mix(np.array([total], _U64)).view(np.int64)[0])


def _sets(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, int]]:
    block = Words(texts, lower=True)
    for i in range(len(texts)):
        found = shingles(block.hash[block.first[i] : block.first[i + 1]])
        yield found, class_of(found) if len(found) else 0


def least_overlap(one: np.ndarray | int, other: np.ndarray | int) -> np.ndarray | int:
    """The smallest overlap with which sets of these sizes are linked."""
    return -(-PERCENT * (one + other) // (100 + PERCENT))


_PROFILES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("class", T.LongType()),
        T.StructField("slot", T.LongType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def _profiles(counters: int):
    """A row per document; at the end of a task also its part of the sketch."""

    def start():
        counts = np.zeros(counters, np.int32)
        seen: set[int] = set()

        def compute(texts=None, ids=None):
            if texts is None:
                slots = [i for i in range(counters // _SLICE) if counts[i * _SLICE : (i + 1) * _SLICE].any()]
                packed = [zlib.compress(counts[i * _SLICE : (i + 1) * _SLICE].tobytes(), 1) for i in slots]
                return [None] * len(slots), [None] * len(slots), [None] * len(slots), slots, packed
            sizes, classes = [], []
            for found, number in _sets(texts):
                sizes.append(len(found))
                classes.append(number)
                if len(found) and number not in seen:
                    seen.add(number)
                    slots = (found & _U64(counters - 1)).astype(np.int64)
                    np.add.at(counts, slots, 1)
            return ids, sizes, classes, [None] * len(ids), [None] * len(ids)

        return compute

    return start


_SKETCH = T.StructType([T.StructField("slot", T.LongType()), T.StructField("counts", T.BinaryType())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the slices that tasks have counted; holds each slot of this task once."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(packed), np.int32)
            held = totals.setdefault(slot, np.zeros(_SLICE, np.int64))
            held += counts
    if totals:
        packed = [np.minimum(t, 2**31 - 1).astype(np.int32).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int64()), pa.array(packed, pa.binary())], names=_SKETCH.names
        )


def _sketch(profiles: DataFrame, counters: int) -> np.ndarray:
    """Estimated number of documents of a shingle, by the low bits of its hash."""
    slices = profiles.where("slot IS NOT NULL").select("slot", "counts")
    counts = np.zeros(counters, np.int32)
    # counters * 4 bytes in all, however many documents there are.
    for row in slices.repartition("slot").mapInArrow(_added, _SKETCH).toLocalIterator():
        at = row["slot"] * _SLICE
        counts[at : at + _SLICE] = np.frombuffer(row["counts"], np.int32)
    return counts


_POSTINGS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("token", "size", "class", "position")]
)


def _postings(sketch):
    """The prefix of each set: enough of its rarest shingles to meet any linked set."""

    def start():
        counts = sketch.value
        counters = len(counts)
        seen: set[int] = set()

        def compute(texts):
            tokens, sizes, classes, positions = [], [], [], []
            for found, number in _sets(texts):
                if not len(found) or number in seen:
                    continue
                seen.add(number)
                prefix = len(found) - (-(-PERCENT * len(found) // 100)) + 1
                frequency = counts[(found & _U64(counters - 1)).astype(np.int64)]
                tokens.append(found[np.lexsort((found, frequency))[:prefix]])
                sizes.append(len(found))
                classes.append(number)
                positions.append(np.arange(prefix))
            if not tokens:
                return None
            times = [len(t) for t in tokens]
            return (
                np.concatenate(tokens).view(np.int64),
                np.repeat(np.array(sizes, np.int64), times),
                np.repeat(np.array(classes, np.int64), times),
                np.concatenate(positions),
            )

        return compute

    return start


def whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that no list (first column) is divided."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        change = np.flatnonzero(columns[0][1:] != columns[0][:-1])
        begins_anew = held and len(columns[0]) and held[-1][0][-1] != columns[0][0]
        if not len(columns[0]):
            continue
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut or begins_anew:
            ready = [*held, [c[:cut] for c in columns]] if cut else held
            yield [np.concatenate(parts) for parts in zip(*ready, strict=True)]
            held = []
        held.append([c[cut:] for c in columns])
    if held:
        yield [np.concatenate(parts) for parts in zip(*held, strict=True)]


_LISTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("token", "size", "class", "position", "pivot")]
)


def _could_link(size, position, other_size, other_position):
    """Whether sets that meet here could still reach the overlap they need."""
    small, large = np.minimum(size, other_size), np.maximum(size, other_size)
    rest = np.minimum(size - position, other_size - other_position)
    return (100 * small >= PERCENT * large) & (rest >= least_overlap(size, other_size))


def with_pivots(token, size, number, position) -> list[np.ndarray] | None:
    """Lists of two classes or more, each entry with the pivot it can be compared to.

    The position of a common shingle tells how much a set has that is rarer, so the
    entry with the smallest position is the one in the middle of a group of near
    copies. It is the pivot of all that it could link with by size; the next such entry
    is that of the others. An entry is its own pivot if it is one, or if its
    position rules the pivot out.
    """
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (number[1:] != number[:-1])
    token, size, number, position = (c[fresh] for c in (token, size, number, position))
    same = token[1:] == token[:-1]
    several = np.zeros(len(token), bool)
    several[1:] |= same
    several[:-1] |= same
    if not several.any():
        return None
    token, size, number, position = (c[several] for c in (token, size, number, position))
    pivot = number.copy()
    left = np.arange(len(token))
    while len(left):
        first = np.ones(len(left), bool)
        first[1:] = token[left[1:]] != token[left[:-1]]
        middle = np.lexsort((number[left], position[left], token[left]))
        # Sorting keeps the lists in place, so each list's first is its smallest position.
        lead = left[middle[np.flatnonzero(first)]][np.cumsum(first) - 1]
        small, large = np.minimum(size[lead], size[left]), np.maximum(size[lead], size[left])
        near = 100 * small >= PERCENT * large
        fits = near & _could_link(size[left], position[left], size[lead], position[lead])
        pivot[left[fits]] = number[lead[fits]]
        left = left[~near]
    return [token, size, number, position, pivot]


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for columns in whole_lists(batches):
        made = with_pivots(*columns)
        if made is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=_LISTS.names)


_PAIRS = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b")])


def open_pairs(size, number, position, root, pivot, distance) -> np.ndarray:
    """Pairs of one list that no set relation settles, as rows of two classes.

    ``size`` ascends. ``distance`` is that from ``pivot`` (NaN if not computed). Entries of
    the component that is most frequent in the list are never compared with each
    other, so only the other entries are gone through.
    """
    out = []
    count = len(size)
    # What an entry offers at best: its set from this position on.
    rest = size - position
    best = np.maximum.reduceat(rest, np.arange(0, count, _BLOCK))
    roots, times = np.unique(root, return_counts=True)
    largest = root == roots[times.argmax()]
    for i in np.flatnonzero(~largest).tolist():
        low = int(np.searchsorted(size, -(-PERCENT * size[i] // 100)))
        high = int(np.searchsorted(size, 100 * size[i] // PERCENT, side="right"))
        need = least_overlap(size[i], size[low])  # the least that any partner needs
        if rest[i] < need:
            continue
        block = np.arange(low // _BLOCK, -(-high // _BLOCK))
        block = block[best[block] >= need]
        at = (block[:, None] * _BLOCK + np.arange(_BLOCK)).ravel()
        at = at[(at >= low) & (at < high)]
        at = at[(root[at] != root[i]) & (largest[at] | (at > i))]
        keep = _could_link(size[i], position[i], size[at], position[at])
        apart = np.abs(distance[at] - distance[i])  # NaN compares as not larger
        keep &= ~((pivot[at] == pivot[i]) & (apart > 1 - PERCENT / 100 + 1e-9))
        at = at[keep]
        if len(at):
            out.append(np.stack([np.full(len(at), number[i]), number[at]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for token, size, number, position, root, pivot, distance in whole_lists(batches):
        begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        lengths = np.diff(np.append(begins, len(token)))
        mixed = np.minimum.reduceat(root, begins) != np.maximum.reduceat(root, begins)
        found = [
            open_pairs(*(c[b : b + n] for c in (size, number, position, root, pivot, distance)))
            for b, n in zip(begins[mixed].tolist(), lengths[mixed].tolist(), strict=True)
        ]
        if found:
            pairs = np.concatenate(found)
            pairs.sort(axis=1)
            pairs = np.unique(pairs, axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=_PAIRS.names
                )


_WHOLE = T.StructType(
    [T.StructField("class", T.LongType()), T.StructField("set", T.ArrayType(T.LongType()))]
)


def _whole_sets(marked):
    """The sets of the classes marked in a bitmap, once per task."""

    def start():
        bits = marked.value
        seen: set[int] = set()

        def compute(texts):
            classes, sets = [], []
            for found, number in _sets(texts):
                slot = number % _MARKED_BITS
                if len(found) and bits[slot >> 3] >> (slot & 7) & 1 and number not in seen:
                    seen.add(number)
                    classes.append(number)
                    sets.append(found.view(np.int64))
            return (classes, sets) if classes else None

        return compute

    return start


def _marked(pairs: DataFrame) -> np.ndarray:
    """A bitmap of ``_MARKED_BITS`` bits with those of the classes in ``pairs`` set."""
    number = F.explode(F.array("a", "b")).alias("class")
    slot = F.pmod(F.col("class"), F.lit(_MARKED_BITS)).alias("slot")
    words = pairs.select(number).select(slot).groupBy(F.shiftright("slot", 16).alias("part")).agg(
        F.collect_set(F.expr("CAST(slot AS INT)")).alias("slots")
    )
    bits = np.zeros(_MARKED_BITS, bool)
    for row in words.toLocalIterator():  # at most 512 rows of 65,536 numbers each
        bits[np.array(row["slots"], np.int64)] = True
    return np.packbits(bits, bitorder="little")


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` with both set sizes and the overlap, written to the scratch folder."""
    spark = texts.sparkSession
    marked = spark.sparkContext.broadcast(_marked(pairs))
    sets = map_blocks(texts, _whole_sets(marked), _WHOLE)
    sets = sets.groupBy("class").agg(F.any_value("set").alias("set"))
    one = sets.select(F.col("class").alias("_a"), F.col("set").alias("set_a"))
    other = sets.select(F.col("class").alias("_b"), F.col("set").alias("set_b"))
    joined = pairs.join(one.hint("merge"), F.col("a") == F.col("_a")).join(
        other.hint("merge"), F.col("b") == F.col("_b")
    )
    compared = joined.select(
        "a",
        "b",
        F.size("set_a").cast("bigint").alias("n_a"),
        F.size("set_b").cast("bigint").alias("n_b"),
        F.size(F.array_intersect("set_a", "set_b")).cast("bigint").alias("n_both"),
    )
    path = fresh_path(spark, "compared")
    compared.write.parquet(path)
    return spark.read.parquet(path)


def _linked(compared: DataFrame) -> DataFrame:
    union = F.col("n_a") + F.col("n_b") - F.col("n_both")
    return compared.where(100 * F.col("n_both") >= PERCENT * union).select("a", "b")


def similar_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_shingles`` and ``component_id``.

    Words are compared without regard to ASCII case. Two documents link when their
    shingle sets have a Jaccard similarity of ``PERCENT`` % or more; the component is
    named by the smallest id reachable. Null texts and texts without words have no
    shingles and are alone; equal rows and repeated ids are rows of their own; a
    null id never names a component unless all its ids are null. An empty table
    gives an empty result. Other columns are not looked at.
    """
    return _grouped(df, doc_id, text).select("doc_id", "n_shingles", "component_id")


def _grouped(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``similar_groups`` with the class of each row's set and the root of its component."""
    spark = df.sparkSession
    documents = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"))
    texts = documents.select("text")
    rows = documents.count()
    counters = min(MOST_COUNTERS, max(_LEAST_COUNTERS, 1 << (16 * rows + 1).bit_length()))
    path = fresh_path(spark, "profiles")
    map_blocks(documents, _profiles(counters), _PROFILES, end=True).write.parquet(path)
    profiles = spark.read.schema(_PROFILES).parquet(path)
    sketch = spark.sparkContext.broadcast(_sketch(profiles, counters))

    importable(df)
    postings = map_blocks(texts, _postings(sketch), _POSTINGS)
    path = fresh_path(spark, "lists")
    (
        postings.repartition("token")
        .sortWithinPartitions("token", "size", "class")
        .mapInArrow(_lists, _LISTS)
        .write.parquet(path)
    )
    lists = spark.read.schema(_LISTS).parquet(path)

    # First the pivot that a class shares most lists with.
    shared = lists.where("class <> pivot").groupBy("class", "pivot").agg(F.count(F.lit(1)).alias("n"))
    chosen = shared.groupBy("class").agg(F.max(F.struct("n", "pivot")).alias("best"))
    first = chosen.select(F.col("class").alias("a"), F.col("best.pivot").alias("b"))
    path = fresh_path(spark, "first")
    first.write.parquet(path)
    compared = _verified(texts, spark.read.schema(_PAIRS).parquet(path))
    roots = connected_components(_linked(compared))

    # Then whatever pairs of different components neither relation settles.
    union = F.col("n_a") + F.col("n_b") - F.col("n_both")
    answers = compared.select(
        F.col("a").alias("_class"), F.col("b").alias("_pivot"), (1 - F.col("n_both") / union).alias("_distance")
    )
    known = answers.join(roots, F.col("_class") == F.col("node"), "full").select(
        F.coalesce("_class", "node").alias("_known"), "_pivot", "_distance", "root"
    )
    labelled = lists.join(known, F.col("class") == F.col("_known"), "left").select(
        "token", "size", "class", "position",
        F.coalesce("root", "class").alias("root"),
        F.coalesce("_pivot", "class").alias("pivot"),
        F.when(F.col("_pivot").isNull(), F.lit(0.0)).otherwise(F.col("_distance")).alias("distance"),
    )
    importable(df)
    pairs = (
        labelled.repartition("token")
        .sortWithinPartitions("token", "size", "class")
        .mapInArrow(_open_pairs, _PAIRS)
        .distinct()
    )
    path = fresh_path(spark, "pairs")
    pairs.write.parquet(path)
    further = _verified(texts, spark.read.schema(_PAIRS).parquet(path))
    roots = connected_components(_linked(compared).union(_linked(further)))

    rows = profiles.where("slot IS NULL").select("doc_id", "n_shingles", "class")
    classes = rows.where("n_shingles > 0").groupBy(F.col("class").alias("_class")).agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots, F.col("_class") == F.col("node"), "left").select(
        "_class", "least", F.coalesce("root", "_class").alias("root")
    )
    smallest = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component"))
    named = rooted.join(smallest, F.col("root") == F.col("_root")).select("_class", "component", "root")
    filled = F.when(F.col("n_shingles") > 0, F.col("class"))
    return rows.join(named, filled == F.col("_class"), "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        "class",
        "root",
    )


_CLASS = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("class", T.LongType())])


def _classes(texts: Sequence[str | None]) -> Sequence:
    return list(zip(*[(len(found), number) for found, number in _sets(texts)], strict=True)) or [(), ()]


def one_of_each_group(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group, the one with the smallest id.

    A row without an id stays only where no row of its group has one. Where several rows
    of a group share the id, the set with the smallest number stays, and of equal sets any
    one row; rows of one id whose texts are in different groups are judged apart. Rows
    without words are alone, so all of them stay. Other columns are kept whatever their
    names.

    Ids that stand on one row say which row stays. Rows whose id is missing or stands on
    several are told apart by their sets, which are found again for these rows alone.
    """
    groups = _grouped(df, doc_id, text)
    path = fresh_path(df.sparkSession, "groups")
    groups.write.parquet(path)
    groups = df.sparkSession.read.schema(groups.schema).parquet(path)
    worded = groups.where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull().alias("bare"), F.col("doc_id"), F.col("class"))
    best = worded.groupBy("root").agg(F.min(order).alias("best"))
    chosen = best.select(F.col("best.doc_id").alias("kept_id"), F.col("best.class").alias("kept_class"))
    same_id = F.col("number") == F.col("kept_id")
    gone = worded.select(F.col("doc_id").alias("number")).join(chosen, same_id, "left_anti").distinct()
    several = groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("number")).agg(F.count("*").alias("n"))
    several = several.where("n > 1").select("number")

    rows = df.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("number"), F.col(f"`{text}`").alias("text"))
    known = rows.where("number IS NOT NULL")
    single = known.join(several, "number", "left_anti").join(gone, "number", "left_anti")
    shared = known.join(several, "number", "left_semi").unionByName(rows.where("number IS NULL"))
    judged = append_columns(shared, ["text"], _classes, _CLASS, ["row", "number"])
    same_set = F.col("number").eqNullSafe(F.col("kept_id")) & (F.col("class") == F.col("kept_class"))
    one = judged.where("n_shingles > 0").dropDuplicates(["number", "class"]).join(chosen, same_set, "left_semi")
    return reduce(DataFrame.union, [d.select("row.*") for d in (single, one, judged.where("n_shingles = 0"))])
