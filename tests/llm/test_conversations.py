"""Conversation repair against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import conversations
from millrace.llm.conversations import LETTERS, Grammar, Repair, learn_grammar, letter, repair_conversations, repaired_roles

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WANTED = re.compile(r"(s?(ua)+)?")
SOUND = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """Least cost and audit of (initial, fault) rows, by trying every edit."""
    best = None
    options = []
    for initial, fault in rows:
        ways = [(4, "D", "")]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            ways += [(more, "K", initial), (3 + more, "R", "u"), (3 + more, "R", "a")]
        options.append(ways)
    inserts = [(3 * n, "I" * n, "".join(p)) for n in range(3) for p in itertools.product("ua", repeat=n)]
    places = [part for ways in options for part in (inserts, ways)] + [inserts]
    for chosen in itertools.product(*places):
        if WANTED.fullmatch("".join(c[2] for c in chosen)):
            found = (sum(c[0] for c in chosen), "".join(c[1] for c in chosen))
            best = min(best or found, found)
    return best


def by_steps(rows):
    """The same, row by row over the states of the pattern."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    ways = {"": (0, "")}

    def better(into, state, cost, audit):
        into[state] = min(into.get(state, (cost, audit)), (cost, audit))

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                for role in "ua":
                    if (state, role) in follow:
                        better(ways, follow[state, role], cost + 3, audit + "I")
        return ways

    for initial, fault in rows:
        after = {}
        for state, (cost, audit) in inserted(ways).items():
            better(after, state, cost + 4, audit + "D")
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for price, edit, role in ((0, "K", initial), (3, "R", "u"), (3, "R", "a")):
                    if (state, role) in follow:
                        better(after, follow[state, role], cost + price + more, audit + edit)
        ways = after
    ways = inserted(ways)
    return min(ways[state] for state in ("", "a") if state in ways)


def damage(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def expected(rows):
    groups = {conv: [] for conv, *_ in rows}
    for conv, *row in damage(rows):
        groups[conv].append(row)
    out = []
    for conv, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in mine:
            sound = SOUND.findall(text)
            faults.append(
                "blank" if not sound else "duplicate" if (role, text) in seen
                else "truncated" if sound[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in mine]
        cost, audit = by_steps(list(zip(initials, faults)))
        turns = {t for t, _, _ in mine if t is not None}
        left, lines, source = len(audit.replace("D", "")), [], iter(mine)
        for edit in audit:
            row = None if edit == "I" else next(source)
            if edit != "D":
                place = len(lines) - left % 2
                role = row[1] if edit == "K" else ("user", "assistant")[place % 2]
                lines.append(f"{role}:{row[2] if row else ''}")
        count = collections.Counter(faults)
        out.append(
            (
                conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"],
                count["duplicate"], count["truncated"],
                sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def invented(seed, conversations=60, most=12):
    chance = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "Uri", "sa"]
    texts = ["Yes.", "No", "", " \n", None, "Why?", "a\x1c", "é!", "x" * 40, "Go! now", "...", "\x85."]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(chance.randint(1, most)):
            row = (conv, chance.choice([turn, turn, turn, turn // 2, 3 * turn, None]), chance.choice(roles), chance.choice(texts))
            rows += [row] * chance.choice([1, 1, 1, 2])
    return rows


def test_matrices_agree_with_every_edit():
    chance = random.Random(5)
    grammar = Grammar()
    for _ in range(12):
        rows = [(chance.randrange(4), chance.randrange(4)) for _ in range(chance.randint(0, 3))]
        repair = Repair(grammar)
        repair.add("".join(letter(*row) for row in rows))
        named = [("suax"[role], conversations.FAULTS[fault]) for role, fault in rows]
        assert repair.best() == cheapest(named) == by_steps(named)


def test_rules_give_what_their_letters_give():
    chance = random.Random(6)
    likely = [letter(1, 0), letter(2, 0), letter(0, 0), letter(1, 1), letter(2, 3), letter(3, 0), letter(2, 2)]
    texts = ["".join(chance.choices(likely, [8, 8, 1, 2, 2, 1, 2], k=chance.randint(0, 60))) for _ in range(300)]
    texts += ["".join(chance.choices(LETTERS, k=40)) for _ in range(50)]
    grammar = Grammar()
    pairs = collections.Counter(a + b for t in texts for a, b in itertools.pairwise(t))
    for _ in range(120):
        grammar.add(pairs.most_common(1)[0][0])
        pairs = collections.Counter(a + b for t in map(grammar.compress, texts) for a, b in itertools.pairwise(t))
    for text in texts:
        named = [("suax"[n // 4], conversations.FAULTS[n % 4]) for n in (ord(c) - ord("A") for c in text)]
        whole = Repair(grammar)
        whole.add(grammar.compress(text))
        cut = Repair(grammar)
        for start in range(0, len(text), 7):
            cut.add(grammar.compress(text[start : start + 7]))
        assert whole.best() == cut.best() == by_steps(named)


def test_roles_follow_from_the_audit():
    assert list(repaired_roles("KKK")) == ["system", "user", "assistant"]
    assert list(repaired_roles("DIRDKI")) == ["", "user", "assistant", "", "user", "assistant"]
    assert list(repaired_roles("")) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_brute_force(spark, seed):
    rows = invented(seed)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns(
        {c: F.lit("clash") for c in ("kind", "digest", "letters", "part", "gone", "cost", "_kind", "n")}
    )
    result = repair_conversations(table, piece_rows=4)
    assert result.columns == (
        "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    )
    assert sorted(map(tuple, result.collect()), key=repr) == expected(rows)


def test_one_long_conversation(spark):
    """Many rows, many of them copies, and one very long text."""
    rows = [(7, n, ("user", "assistant")[n % 2], f"Line {n}.") for n in range(3000)]
    rows += [(7, 40, "user", "again and again")] * 1500 + [(7, 2999, "user", "é " * 300_000 + ".")]
    rows += [(8, 0, "system", "Be brief."), (8, 1, "user", "Hi."), (9, None, None, None)]
    result = repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert sorted(map(tuple, result.collect()), key=repr) == expected(rows)


def test_empty_table_and_dropped_rows(spark):
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    row = repair_conversations(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_grammar_is_learned_from_all_strings(spark):
    common, rare = letter(1, 0) + letter(2, 0), letter(0, 0) + letter(0, 1)
    rows = [(common * 4, 5), (rare, 1), (letter(3, 0), 9)]
    grammar = learn_grammar(spark.createDataFrame(rows, "letters string, n bigint"))
    assert list(grammar.pairs)[0] == common
    assert len(grammar.compress(common * 4)) == 1
    assert rare not in grammar.pairs
    few = learn_grammar(spark.createDataFrame(rows, "letters string, n bigint"), most_rules=1)
    assert len(few.pairs) == 1
