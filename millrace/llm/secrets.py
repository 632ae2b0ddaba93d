"""Secret scanning judged by who owns copies of a credential.

Candidates are found by pattern in whole texts. The digest of every candidate is
then counted over the whole corpus: in how many distinct repositories, and of how
many distinct owners, it occurs. One that ``EXAMPLE_OWNERS`` owners or more hold
is a widely copied example; any other looks live. Long random strings that no
pattern names (kind ``generic``) count as secrets only if they look live.
Values leave the scan as digests only.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import append_columns
from millrace.scratch import fresh_path

EXAMPLE_OWNERS = 3
KINDS = ("assign", "access", "hex", "generic")
_GENERIC = 3
_LEAST_ENTROPY = 3.5
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RANDOM = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

Span = tuple[int, int, int, str]  # kind, start, end, value


def base_spans(text: str) -> list[Span]:
    """The pattern matches of a text, by start and then kind."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [
            (0, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12
        ]
    found += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _entropy(value: str) -> float:
    counts = Counter(value).values()
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts)


def generic_spans(text: str, taken: Sequence[Span]) -> list[Span]:
    """Long strings of mixed letters and digits with high entropy, clear of ``taken``."""
    found = []
    for m in _RANDOM.finditer(text):
        value = m[0]
        mixed = re.search("[0-9]", value) and re.search("[A-Z]", value) and re.search("[a-z]", value)
        if not mixed or any(s < m.end() and m.start() < e for _, s, e, _ in taken):
            continue
        if _entropy(value) >= _LEAST_ENTROPY:
            found.append((_GENERIC, m.start(), m.end(), value))
    return found


def listed(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in spans)


_LONGS = T.ArrayType(T.LongType())
_FIELDS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")]
    + [T.StructField("base_sha256", T.StringType())]
    + [T.StructField(n, _LONGS) for n in ("_kinds", "_starts", "_ends")]
    + [T.StructField("_digests", T.ArrayType(T.StringType()))]
)


def _scan(texts: Sequence[str | None]) -> tuple:
    rows = []
    for text in texts:
        base = base_spans(text or "")
        kinds = Counter(s[0] for s in base)
        spans = sorted([*base, *generic_spans(text or "", base)], key=lambda s: (s[1], s[0]))
        digests = [hashlib.sha256(s[3].encode()).hexdigest() for s in spans]
        digest = hashlib.sha256(listed(base).encode()).hexdigest()
        columns = [list(c) for c in zip(*[s[:3] for s in spans], strict=True)] or [[], [], []]
        rows.append((kinds[0], kinds[1], kinds[2], digest, *columns, digests))
    return tuple(zip(*rows, strict=True))


def ownership(found: DataFrame) -> DataFrame:
    """Per digest: distinct repositories and owners, and documents, over the corpus.

    Rows are first counted per digest and repository, so copies within one never
    meet in one task.
    """
    per_repository = found.groupBy("digest", "repository", "owner").agg(
        F.count(F.lit(1)).alias("n_spans")
    )
    # An owner's repositories are counted before its digest's owners are.
    per_owner = per_repository.groupBy("digest", "owner").agg(
        F.count("repository").alias("n_repositories"), F.sum("n_spans").alias("n_spans")
    )
    return per_owner.groupBy("digest").agg(
        F.sum("n_repositories").alias("n_repositories"),
        F.count("owner").alias("n_owners"),
        F.sum("n_spans").alias("n_spans"),
    )


def find_secrets(
    df: DataFrame,
    text: str = "text",
    repository: str = "source",
    *,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with the secrets of each text.

    An owner is the part of ``repository`` before its first slash. Added: the
    base counts and digest, ``spans`` (kind:start:end in code points), ``n_live``,
    ``n_example``, and ``live_starts``/``live_ends``. One row per input row. A null text
    counts as empty and has no spans; a null repository belongs to no owner, so what
    only such rows hold looks live; an empty table gives an empty result. Columns
    of ``df`` with names of new ones are replaced.
    """
    keep = df.columns if keep is None else list(keep)
    made = {"spans", "n_live", "n_example", "live_starts", "live_ends"}
    made |= {f.name for f in _FIELDS if not f.name.startswith("_")}
    kept = [c for c in keep if c.lower() not in made]
    # Columns of the caller travel in one of ours, so that their names meet none.
    named = df.select(
        F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(f"_{c}") for c in kept]).alias("_held"),
        F.col(f"`{text}`").alias("_text"),
        F.col(f"`{repository}`").cast("string").alias("_repository"),
    )
    scanned = append_columns(named, ["_text"], _scan, _FIELDS, ["_held", "_repository"])
    path = fresh_path(df.sparkSession, "secrets")
    # Written with a row number, which stays the same in all that is read from here.
    scanned.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    scanned = df.sparkSession.read.parquet(path)
    spans = scanned.where(F.size("_kinds") > 0).select(
        "_row",
        "_repository",
        F.explode(F.arrays_zip("_kinds", "_starts", "_ends", "_digests")).alias("s"),
    )
    spans = spans.select(
        "_row",
        F.col("_repository").alias("repository"),
        F.substring_index("_repository", "/", 1).alias("owner"),
        F.col("s._kinds").alias("kind"),
        F.col("s._starts").alias("start"),
        F.col("s._ends").alias("end"),
        F.col("s._digests").alias("digest"),
    )
    owned = ownership(spans).select(F.col("digest").alias("_digest"), "n_owners")
    judged = spans.join(owned, F.col("digest") == F.col("_digest"))
    live = F.col("n_owners") < EXAMPLE_OWNERS
    shown = (F.col("kind") != _GENERIC) | live
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("kind") + 1).cast("int"))
    entry = F.struct("start", "kind", "end", F.concat_ws(":", name, "start", "end").alias("shown"), live.alias("live"))
    # A document's spans only: as many as one text holds.
    per_row = (
        judged.where(shown)
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(entry)).alias("_all"))
        .withColumnRenamed("_row", "_span_row")
    )
    joined = scanned.join(per_row, F.col("_row") == F.col("_span_row"), "left")
    nothing = F.array().cast("array<bigint>")
    found = F.filter("_all", lambda s: s["live"])
    count = lambda column: F.coalesce(F.size(column), F.lit(0)).cast("bigint")
    live_count = F.when(F.col("_all").isNull(), 0).otherwise(count(found)).cast("bigint")
    all_count = F.when(F.col("_all").isNull(), 0).otherwise(count("_all")).cast("bigint")
    return joined.select(
        *[F.col("_held").getField(f"_{c}").alias(c) for c in kept],
        "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(F.array_join(F.transform("_all", lambda s: s["shown"]), ","), F.lit("")).alias("spans"),
        live_count.alias("n_live"),
        (all_count - live_count).alias("n_example"),
        F.coalesce(F.transform(found, lambda s: s["start"]), nothing).alias("live_starts"),
        F.coalesce(F.transform(found, lambda s: s["end"]), nothing).alias("live_ends"),
    )


MASK = "[secret]"


def _masked(texts, starts, ends) -> tuple:
    out = []
    for text, begins, finishes in zip(texts, starts, ends, strict=True):
        if text is not None and begins:
            parts, at = [], 0
            for start, end in sorted(zip(begins, finishes, strict=True)):
                if end <= at:
                    continue
                if start >= at:
                    parts += [text[at:start], MASK]
                at = end
            text = "".join([*parts, text[at:]])
        out.append(text)
    return (out,)


def mask_secrets(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of ``find_secrets`` with its live-looking spans masked in ``text``.

    Overlapping spans become one mask; examples stay as they are.
    """
    field = T.StructType([T.StructField(text, T.StringType())])
    order = found.columns
    masked = append_columns(found, [text, "live_starts", "live_ends"], _masked, field)
    return masked.select(*[f"`{c}`" for c in order])
