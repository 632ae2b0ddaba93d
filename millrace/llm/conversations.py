"""Repairing the order of speakers in damaged conversations at least cost.

A conversation becomes a string with one letter per row, for its role and fault. Re-Pair
compresses the strings of all conversations together: rounds count neighbouring symbols
over the whole corpus and replace the most frequent pairs by new symbols. Every rule has
one min-plus transfer matrix, made of those of its two halves: from each state of the
wanted pattern to each other, the least cost of repairing what the rule stands for, and
the state between the halves, which makes the audit a rope that is only read out when it
is needed. Conversations then multiply the few matrices of their compressed strings.

States of the pattern ``(s?(ua)+)?``: nothing yet, after the system row, after a user row,
after an assistant row. Nothing yet and after an assistant row may end a conversation.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import batched, count, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import arrow_types, blocks, importable, map_blocks
from millrace.scratch import fresh_path

#: Rows of a conversation that one string holds; longer ones have several.
PIECE_ROWS = 256
ROUNDS = 12
#: Matrices that every task gets; further pairs stay as they are.
MOST_RULES = 1000
_PAIRS_ASKED = 256

DROP, EMPTY, CUT, REPEAT, CLAIM = range(5)
KINDS = 20
SPACES = " \t\n\x0b\x0c\r"
ROLES = "sua"
FAULTS = ("", "blank", "duplicate", "truncated")
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_LEGAL = {"su", "ua", "au"}
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_STATES = range(4)
_ENDS = (0, 3)
REROLE, DELETE, INSERT, UNTRUNCATE = 3, 4, 3, 3
_FAR = 1 << 60
_FIRST_LETTER, _FIRST_RULE = ord("A"), 0x4E00

Cell = tuple[int, str]


# -- letters and matrices ------------------------------------------------------
def letter(role: int, fault: int) -> str:
    """The letter of a row; ``role`` is its place in ``ROLES``, or 3 for any other."""
    return chr(_FIRST_LETTER + 4 * role + fault)


LETTERS = [letter(role, fault) for role in range(4) for fault in range(4)]


def _role(symbol: str) -> str:
    return "sua?"[(ord(symbol) - _FIRST_LETTER) // 4]


def _inserts() -> list[list[Cell]]:
    """Cheapest runs of inserted rows from state to state."""
    cells = [[(0, "") if i == j else (_FAR, "") for j in _STATES] for i in _STATES]
    for _ in _STATES:
        for i in _STATES:
            for (state, role), after in _NEXT.items():
                cost, audit = cells[i][state]
                if role != "s" and cost < _FAR:
                    cells[i][after] = min(cells[i][after], (cost + INSERT, audit + "I"))
    return cells


INSERTS = _inserts()


def letter_matrix(symbol: str) -> list[list[Cell]]:
    """Least cost and audit of inserts followed by one row, from state to state."""
    fault = (ord(symbol) - _FIRST_LETTER) % 4
    cells = [[(_FAR, "")] * 4 for _ in _STATES]
    for i in _STATES:
        for k in _STATES:
            before, audit = INSERTS[i][k]
            edits = [(DELETE, "D", k)]
            if fault in (_FINE, _TRUNCATED):
                extra = UNTRUNCATE if fault == _TRUNCATED else 0
                edits += [(extra, "K", _NEXT.get((k, _role(symbol))))]
                edits += [(REROLE + extra, "R", _NEXT.get((k, role))) for role in "ua"]
            for cost, edit, j in edits:
                if j is not None and before < _FAR:
                    cells[i][j] = min(cells[i][j], (before + cost, audit + edit))
    return cells


@dataclass
class Grammar:
    """Rules of two symbols each, with their matrices.

    ``costs[symbol][4 * i + j]`` is the least cost from state ``i`` to ``j``, and
    ``middles`` holds the state between the halves of the audit that is ASCII-least
    among the cheapest. No such audit begins another one of the same rows and cost, as
    each further insert costs, so the least halves make the least whole.
    """

    pairs: dict[str, str] = field(default_factory=dict)
    costs: dict[str, list[int]] = field(default_factory=dict)
    middles: dict[str, list[int]] = field(default_factory=dict)
    audits: dict[str, list[str | None]] = field(default_factory=dict)
    halves: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for symbol in LETTERS:
            cells = [cell for row in letter_matrix(symbol) for cell in row]
            self.costs[symbol] = [cost for cost, _ in cells]
            self.audits[symbol] = [audit for _, audit in cells]

    def add(self, pair: str) -> None:
        left, right = self.costs[pair[0]], self.costs[pair[1]]
        symbol = chr(_FIRST_RULE + len(self.pairs))
        costs, middles = [], []
        for i in _STATES:
            for j in _STATES:
                least, best = _FAR, 0
                for k in _STATES:
                    cost = left[4 * i + k] + right[4 * k + j]
                    if cost < least or (cost == least < _FAR and self._before(pair, i, k, best, j)):
                        least, best = cost, k
                costs.append(least)
                middles.append(best)
        self.pairs[pair], self.halves[symbol] = symbol, pair
        self.costs[symbol], self.middles[symbol] = costs, middles

    def _before(self, pair: str, i: int, k: int, other: int, j: int) -> bool:
        """Whether the audit through state ``k`` comes before the one through ``other``."""
        one = self._letters((pair[1], k, j), (pair[0], i, k))
        two = self._letters((pair[1], other, j), (pair[0], i, other))
        return next((a < b for a, b in zip(one, two, strict=False) if a != b), False)

    def _letters(self, *stack: tuple[str, int, int]) -> Iterator[str]:
        """The letters of a rope, given from its last part to its first."""
        parts = list(stack)
        while parts:
            symbol, i, j = parts.pop()
            if symbol in self.middles:
                k = self.middles[symbol][4 * i + j]
                left, right = self.halves[symbol]
                parts += [(right, k, j), (left, i, k)]
            else:
                yield from self.audits[symbol][4 * i + j]

    def audit(self, symbol: str, i: int, j: int) -> str:
        """The audit of a symbol from state to state, read out once."""
        if symbol not in self.audits:
            self.audits[symbol] = [None] * 16
        read = self.audits[symbol]
        if read[4 * i + j] is None:
            read[4 * i + j] = "".join(self._letters((symbol, i, j)))
        return read[4 * i + j]

    def compress(self, text: str) -> str:
        for pair, symbol in self.pairs.items():
            text = text.replace(pair, symbol)
        return text


class Repair:
    """The cheapest audits of a conversation's rows so far, one per state.

    What all of them begin with is set aside, so that they stay short.
    """

    def __init__(self, grammar: Grammar) -> None:
        self.grammar = grammar
        self.begin: list[str] = []
        self.ways: dict[int, Cell] = {0: (0, "")}

    def add(self, symbols: str) -> None:
        for symbol in symbols:
            costs = self.grammar.costs[symbol]
            after: dict[int, Cell] = {}
            for j in _STATES:
                found = [(c + costs[4 * i + j], i) for i, (c, _) in self.ways.items()]
                least = min(found)[0]
                if least < _FAR:
                    audits = [self.ways[i][1] + self.grammar.audit(symbol, i, j) for c, i in found if c == least]
                    after[j] = (least, min(audits))
            self.ways = after
        shared = os.path.commonprefix([audit for _, audit in self.ways.values()])
        if shared:
            self.begin.append(shared)
            self.ways = {j: (cost, audit[len(shared) :]) for j, (cost, audit) in self.ways.items()}

    def best(self) -> Cell:
        ends = [
            (cost + INSERTS[i][j][0], audit + INSERTS[i][j][1])
            for i, (cost, audit) in self.ways.items()
            for j in _ENDS
        ]
        cost, audit = min(ends)
        return cost, "".join([*self.begin, audit])


def repaired_roles(audit: str) -> Iterator[str]:
    """Per edit the role it leads to; empty where a row goes.

    The pattern leaves no choice: an odd number of rows begins with the system's.
    """
    place = -((len(audit) - audit.count("D")) % 2)
    for edit in audit:
        if edit == "D":
            yield ""
        else:
            yield "system" if place < 0 else ("user", "assistant")[place % 2]
            place += 1


# -- rows ------------------------------------------------------------------------
def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` after damage; ``gone`` marks dropped rows.

    Null roles and texts count as one space, and so do null ids where the kind of damage
    is drawn.
    """
    space = F.lit(" ")
    drawn = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    text = F.coalesce(F.col("text"), space)
    kind = F.col("_kind")
    spoiled = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), space).alias("role"),
        text.alias("text"),
        (F.crc32(drawn) % KINDS).cast("int").alias("_kind"),
    )
    return spoiled.select(
        "conv_id",
        "turn",
        F.when(kind == CLAIM, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == EMPTY, "")
        .when(kind == CUT, F.regexp_replace("text", "[.!?]+", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (kind == DROP).alias("gone"),
        F.explode(F.when(kind == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _marked_rows(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one, with their number, and whether the first is new.

    Texts are left behind for digests. The first turn of a role and text is aggregated
    map-side and joined back on all that tells rows apart, so no repeated text gathers.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    role = F.coalesce(*[F.when(initial == r, i) for i, r in enumerate(ROLES)], F.lit(len(ROLES)))
    keys = ["conv_id", "turn", "role", "digest"]
    facts = rows.select(
        "conv_id",
        F.when(~F.col("gone"), F.col("turn")).alias("turn"),
        F.when(F.col("gone"), "").otherwise(F.col("role")).alias("role"),
        F.when(~F.col("gone"), _digest(F.col("text"))).alias("digest"),
        role.alias("initial"),
        F.when(bare == "", _BLANK)
        .when(F.right(bare, F.lit(1)).isin(".", "!", "?"), _FINE)
        .otherwise(_TRUNCATED)
        .alias("fault"),
        (~F.col("gone")).cast("int").alias("there"),
    )
    held = facts.groupBy(*keys).agg(
        F.sum("there").alias("n"), F.max("initial").alias("initial"), F.max("fault").alias("fault")
    )
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = facts.where("digest IS NOT NULL").groupBy("conv_id", "role", "digest").agg(F.min(order).alias("least"))
    first = first.select(
        F.col("conv_id").alias("first_conv"),
        F.col("least.turn").alias("first_turn"),
        F.col("role").alias("first_role"),
        F.col("digest").alias("first_digest"),
    )
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(keys, first.columns, strict=True)]
    new = F.col("first_digest").isNotNull()
    return held.join(first, same, "left").select(*keys, "n", "initial", "fault", new.alias("new"))


def _stream(
    df: DataFrame, generate: Callable[[Iterator[tuple]], Iterator[tuple]], fields: T.StructType
) -> DataFrame:
    """What a generator makes of the rows of each task, read and written in small batches."""
    types = arrow_types(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for block in blocks(batch, 0)
            for row in zip(*[c.to_pylist() for c in block.columns], strict=True)
        )
        for made in batched(generate(rows), 1024):
            columns = zip(zip(*made, strict=True), types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in columns], names=fields.names)

    importable(df)
    return df.mapInArrow(run, fields)


def _strings(piece_rows: int) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """Cuts sorted rows into strings of one conversation each."""

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        pieces = count()
        for (conv, part), mine in groupby(rows, key=itemgetter(0, 1)):
            text: list[str] = []
            known: list = []

            def piece() -> tuple:
                ends = (known[0], known[-1]) if known else (None, None)
                return (conv, part, next(pieces), "".join(text), *ends, len(set(known)))  # noqa: B023

            for _, _, turn, n, role, fault, new in mine:
                again = letter(role, _BLANK if fault == _BLANK else _DUPLICATE)
                while n:
                    if len(text) == piece_rows:
                        yield piece()
                        text, known = [], []
                    take = min(n, piece_rows - len(text))
                    text += [letter(role, fault) if new else again] + [again] * (take - 1)
                    known += [turn] if turn is not None else []
                    new, n = False, n - take
            yield piece()

    return cut


def conversation_strings(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Every conversation as strings of letters in order, ``piece_rows`` rows at most each.

    Rows are dealt by ranges of conversation and order, so that the rows of one long
    conversation, too, divide into tasks; ``part`` and ``piece`` put its strings in order.
    Rows of one turn are ordered by role and then by the SHA-256 of their text. A
    conversation whose rows are all dropped has an empty string.
    """
    order = ["conv_id", "turn", "role", "digest"]
    placed = _marked_rows(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("conv_id", F.spark_partition_id().alias("part"), "turn", "n", "initial", "fault", "new")
    turn = placed.schema["turn"].dataType
    fields = T.StructType(
        [
            T.StructField("conv_id", placed.schema["conv_id"].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("piece", T.LongType()),
            T.StructField("letters", T.StringType()),
            T.StructField("least_turn", turn),
            T.StructField("most_turn", turn),
            T.StructField("turns", T.LongType()),
        ]
    )
    return _stream(placed, _strings(piece_rows), fields)


# -- grammar -----------------------------------------------------------------------
def _pair_counts(grammar: Grammar) -> Callable[[], Callable[..., Sequence | None]]:
    def start() -> Callable[..., Sequence | None]:
        def tally(texts: list[str], numbers: list[int]) -> Sequence | None:
            pairs: Counter[str] = Counter()
            for text, n in zip(texts, numbers, strict=True):
                symbols = grammar.compress(text)
                last = ""
                for a, b in zip(symbols, symbols[1:], strict=False):
                    # Of overlapping equal pairs, as in aaa, every other one counts.
                    last = "" if a + b == last and a == b else a + b
                    if last:
                        pairs[last] += n
            return (list(pairs), list(pairs.values())) if pairs else None

        return tally

    return start


def learn_grammar(strings: DataFrame, rounds: int = ROUNDS, most_rules: int = MOST_RULES) -> Grammar:
    """Re-Pair over the distinct ``letters`` of all strings, weighted by their number ``n``.

    A round replaces the most frequent pairs that have no symbol in common, since
    replacing one of those does not change the number of another. Pairs that occur once
    make no rule.
    """
    grammar = Grammar()
    fields = T.StructType([T.StructField("pair", T.StringType()), T.StructField("n", T.LongType())])
    for _ in range(rounds):
        pairs = map_blocks(strings.select("letters", "n"), _pair_counts(grammar), fields)
        common = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        used: set[str] = set()
        for row in common.orderBy(F.col("n").desc(), "pair").limit(_PAIRS_ASKED).collect():
            if not used & set(row["pair"]) and len(grammar.pairs) < most_rules:
                used |= set(row["pair"])
                grammar.add(row["pair"])
        if not used:
            break
    return grammar


# -- repair -------------------------------------------------------------------------
class _Conversation:
    """What is known of one conversation while its strings and then its rows go by."""

    def __init__(self, grammar: Grammar) -> None:
        self.repair = Repair(grammar)
        self.last = ""
        self.faults = [0] * 4
        self.illegal = 0
        self.turns: tuple | None = None
        self.distinct = 0
        self.cost, self.audit = 0, None
        self.sha = hashlib.sha256()

    def string(self, letters: str, compressed: str, least, most, turns: int) -> None:
        self.repair.add(compressed)
        for fault in range(4):
            self.faults[fault] += sum(letters.count(letter(role, fault)) for role in range(4))
        spoken = self.last + "".join(map(_role, letters))
        self.illegal += max(len(spoken) - 1, 0) - sum(spoken.count(pair) for pair in _LEGAL)
        self.last = spoken[-1:]
        if least is not None:
            again = self.turns is not None and self.turns[1] == least
            self.distinct += turns - again
            self.turns = (self.turns[0] if self.turns else least, most)

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = self.repair.best()
            self.edits = zip(self.audit, repaired_roles(self.audit), strict=True)
            self.written = 0

    def write(self, line: str) -> None:
        self.sha.update(("\n" * (self.written > 0) + line).encode("utf-8", "surrogatepass"))
        self.written += 1

    def row(self, role: str, text: str) -> None:
        self.settle()
        for edit, new in self.edits:
            if edit == "I":
                self.write(f"{new}:")
                continue
            if edit != "D":
                self.write(f"{role if edit == 'K' else new}:{text}")
            return

    def result(self) -> tuple:
        self.settle()
        for _, new in self.edits:  # inserts behind the last row
            self.write(f"{new}:")
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (
            gaps, *self.faults[1:], self.illegal, self.cost, self.audit, self.sha.hexdigest(),
        )


def _repairs(grammar: Grammar) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """Strings of a conversation come before its rows, rows in order."""

    def repair(rows: Iterator[tuple]) -> Iterator[tuple]:
        compress = lru_cache(maxsize=4096)(grammar.compress)
        for conv, mine in groupby(rows, key=itemgetter(1)):
            now = _Conversation(grammar)
            for text, _, role, letters, least, most, turns in mine:
                if letters is not None:
                    now.string(letters, compress(letters), least, most, turns)
                else:
                    now.row(role, text)
            yield (conv, *now.result())

    return repair


def repair_conversations(
    rows: DataFrame, *, piece_rows: int = PIECE_ROWS, rounds: int = ROUNDS, most_rules: int = MOST_RULES
) -> DataFrame:
    """One row per ``conv_id`` of the damaged ``rows``: its faults and its cheapest repair.

    Null ids are one conversation; null turns come first, and rows of one turn in the
    order of role and SHA-256 of the text. A conversation without rows after damage has
    zeros, an empty audit and the hash of an empty text; an empty table gives no rows.
    Other columns are not looked at. Roles count by their first letter, as does an empty
    role as a letter of its own.

    Letters, grammar and repair divide also within a conversation. The rows of one
    conversation then go through one task in order, one at a time: a SHA-256 of the whole
    cannot be divided. That task holds the audit and one row.
    """
    spark = rows.sparkSession
    rows = damaged(rows)
    path = fresh_path(spark, "conversation-strings")
    strings = conversation_strings(rows, piece_rows)
    strings.write.parquet(path)
    strings = spark.read.schema(strings.schema).parquet(path)
    path = fresh_path(spark, "conversation-kinds")
    strings.groupBy("letters").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    grammar = learn_grammar(spark.read.schema("letters string, n bigint").parquet(path), rounds, most_rules)
    heads = strings.withColumns(
        {"kind": F.lit(0), "text": F.lit(None).cast("string"), "role": F.lit(None).cast("string"),
         "turn": F.lit(None).cast(strings.schema["least_turn"].dataType), "digest": F.lit(None).cast("binary")}
    )
    lines = rows.where("NOT gone").withColumns({"kind": F.lit(1), "digest": _digest(F.col("text"))}).drop("gone")
    order = ["conv_id", "kind", "part", "piece", "turn", "role", "digest"]
    streams = heads.unionByName(lines, allowMissingColumns=True).repartition("conv_id")
    sorted_rows = streams.sortWithinPartitions(*order)
    long = T.LongType()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    fields = T.StructType(
        [
            rows.schema["conv_id"],
            *[T.StructField(n, long) for n in names],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )
    needed = ["text", "conv_id", "role", "letters", "least_turn", "most_turn", "turns"]
    return _stream(sorted_rows.select(*needed), _repairs(grammar), fields)
