"""How filters overlap: what each removes at each place of every order of them.

Documents become masks, one bit per filter they fail, and masks become cells: counts
per part and mask. All that follows works on cells, of which a part has at most
``2 ** filters``, so its work does not grow with documents. A recursive query extends
prefixes of the orders by letters they do not hold yet, carries the bits applied so
far, meets every mask with them, and gives at each level what happens at that step.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.scratch import fresh_path

#: 6 filters make 64 masks and 1,957 prefixes; Spark bounds the rows of a recursion.
MOST_FILTERS = 6
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 2
_SPACES = r"[\x20\x09-\x0D]+"


def text_filters(text: str = "text") -> dict[str, Column]:
    """Whether a text fails each filter that needs no other document.

    A null text counts as empty. ``A``: few words; ``B``: few distinct words; ``C``: many
    capitals; ``D``: holds a symbol.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(whole, _SPACES), "")
    capitals = F.char_length(whole) - F.char_length(F.regexp_replace(whole, "[A-Z]+", ""))
    distinct = F.size(F.array_distinct(words))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * distinct.cast("bigint") < LEAST_DISTINCT_PERCENT * F.size(words).cast("bigint"),
        "C": 100 * capitals.cast("bigint") > MOST_CAPITAL_PERCENT * F.char_length(whole).cast("bigint"),
        "D": whole.rlike("[#$%&*|]"),
    }


def failure_cells(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], copies: str | None
) -> DataFrame:
    """Per part (``source``; null: empty) and mask: documents, good ones and toxic ones.

    Bit ``i`` of a mask is the ``i``-th of ``filters``. ``copies`` names one more filter,
    the last bit, which texts fail that equal the text of a smaller ``doc_id``, wherever
    that one lies; a null ``doc_id`` is neither smaller nor larger than another. Equal
    texts are found by their SHA-256. A document is good or toxic if any of its rows in
    ``labels`` says so; one without rows is neither. Repeated documents count each time.

    Texts are read once: what is kept of them is written, a digest and a mask a row. The
    smallest id of a text is aggregated map-side, and joined on text and id at once, so
    that thousands of copies neither meet in one task nor weigh on one key.
    """
    spark = docs.sparkSession
    bits = [F.when(fails, 2**i).otherwise(0) for i, fails in enumerate(filters.values())]
    facts = docs.select(
        "doc_id",
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"),
        sum(bits, F.lit(0)).alias("mask"),
    )
    path = fresh_path(spark, "filter-facts")
    facts.write.parquet(path)
    facts = spark.read.schema(facts.schema).parquet(path)
    if copies is not None:
        first = facts.groupBy(F.col("digest").alias("text_digest")).agg(F.min("doc_id").alias("first_id"))
        same = (F.col("digest") == F.col("text_digest")) & (F.col("doc_id") == F.col("first_id"))
        later = F.col("first_id").isNull() & F.col("doc_id").isNotNull()
        mask = F.col("mask") + F.when(later, 2 ** len(filters)).otherwise(0)
        facts = facts.join(first, same, "left").select("doc_id", "part", mask.alias("mask"))
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = facts.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return marked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"),
    )


def order_steps(spark, letters: str) -> DataFrame:
    """Every prefix of every order of ``letters`` with every mask, and what becomes of it.

    Columns: ``prefix``, ``letter`` (its last), ``mask`` and, as 0 or 1, ``kept``,
    ``removed``, ``redundant`` and ``unique_fails`` of documents with that mask.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} different letters, not {letters!r}")
    bits = ", ".join(f"('{letter}', {2**i})" for i, letter in enumerate(letters))
    return spark.sql(
        f"""
        WITH RECURSIVE
        filters(letter, bit) AS (VALUES {bits}),
        walk(prefix, letter, applied, mask, kept, removed, redundant, unique_fails) AS (
          SELECT '', '', 0, CAST(id AS INT), 1, 0, 0, 0 FROM range({2 ** len(letters)})
          UNION ALL
          SELECT walk.prefix || filters.letter, filters.letter, applied | bit, mask,
                 CAST(mask & (applied | bit) = 0 AS INT),
                 CAST(mask & bit <> 0 AND mask & applied = 0 AS INT),
                 CAST(mask & bit <> 0 AND mask & applied <> 0 AS INT),
                 CAST(mask = bit AS INT)
          FROM walk JOIN filters ON applied & bit = 0)
        SELECT prefix, letter, mask, kept, removed, redundant, unique_fails
        FROM walk WHERE prefix <> ''"""
    )


def audit_orders(cells: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of ``letters`` and step, zeros included.

    Only prefixes, whose number the letters bound, are broadcast. Orders that begin alike
    share a prefix, so each prefix is counted once and then handed to its orders.
    """
    spark = cells.sparkSession
    path = fresh_path(spark, "filter-orders")
    steps = order_steps(spark, letters)
    steps.coalesce(1).write.parquet(path)
    steps = spark.read.schema(steps.schema).parquet(path)
    met = cells.join(F.broadcast(steps), "mask")
    counted = met.groupBy("part", "prefix", "letter").agg(
        *[F.sum(F.col(c) * F.col("n")).alias(c) for c in ("kept", "removed", "redundant", "unique_fails")],
        F.sum(F.col("removed") * F.col("good")).alias("good_lost"),
        F.sum(F.col("removed") * F.col("toxic")).alias("toxic_lost"),
    )
    # A prefix of k letters begins (all - k)! orders.
    rest = len(letters) - F.length("prefix")
    begun = F.element_at(F.array(*[F.lit(math.factorial(i)) for i in range(len(letters))]), rest + 1)
    whole = counted.groupBy(F.col("part").alias("whole_part"), F.col("letter").alias("whole_letter")).agg(
        F.sum(F.col("removed") * begun).alias("shapley")
    )
    orders = steps.where((F.length("prefix") == len(letters)) & (F.col("mask") == 0))
    places = orders.select(
        F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"),
    ).withColumn("begins", F.expr("substring(filter_order, 1, step)"))
    sums = (F.col("part") == F.col("whole_part")) & (F.col("letter") == F.col("whole_letter"))
    return (
        counted.join(whole, sums)
        .join(F.broadcast(places), F.col("prefix") == F.col("begins"))
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
            "good_lost", "toxic_lost", "shapley",
        )
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters ``A`` to ``E`` (see ``text_filters``; ``E``: later copies).

    An empty table has no parts and so no rows. Empty and null texts fail ``A`` alone (and
    ``E``, if a smaller id has one, too). Other columns of either table are not looked at.
    """
    filters = text_filters()
    return audit_orders(failure_cells(docs, labels, filters, "E"), "".join([*filters, "E"]))
