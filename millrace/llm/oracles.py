"""SQL for the queries that SQL can express, over tables named as in the data folder."""

from __future__ import annotations

from millrace.llm.sharding import ROUND_KEYS

_PRIME = 2_147_483_647


def _crc32(text: str) -> str:
    """The checksum of a text, bit by bit over its UTF-8 bytes."""
    hexadecimal = f"regexp_replace(hex(encode({text})), '(..)', '\\1,', 'g')"
    numbers = (
        f"list_transform(list_filter(string_split({hexadecimal}, ','), lambda p: p <> ''), "
        "lambda p: ('0x' || p)::BIGINT)"
    )
    eight = "list_reduce(list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
    eight += "lambda s, z: xor(s >> 1, (s & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}), lambda c, x: {eight}), 4294967295)"


def _network(number: str) -> str:
    keys = ", ".join(map(str, ROUND_KEYS))
    mixed = f"(((v % side) * 1103515245 + k) % {_PRIME})"
    turned = f"(({mixed} * ({mixed} + 1)) % {_PRIME} * 48271 + k) % {_PRIME}"
    return (
        f"list_reduce(list_prepend(({number})::BIGINT, [{keys}]::BIGINT[]), "
        f"lambda v, k: (v % side) * side + (v // side + {turned}) % side)"
    )


SHARDING = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents),
ordered AS (
  SELECT *, {_crc32("coalesce(doc_id::VARCHAR, 'null') || ':' || text_crc32 || ':' || size")} AS place
  FROM sized),
numbered AS (
  SELECT doc_id, size, text_crc32,
         (row_number() OVER (ORDER BY place, doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS number,
         (count(*) OVER ())::BIGINT AS n
  FROM ordered),
sided AS (SELECT *, ceil(sqrt(n))::BIGINT AS side FROM numbered),
walk AS (
  SELECT doc_id, size, text_crc32, n, side, {_network("number")} AS position FROM sided
  UNION ALL
  SELECT doc_id, size, text_crc32, n, side, {_network("position")} FROM walk WHERE position >= n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (position % 8)::INTEGER AS shard,
       (position // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE position < n"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JACCARD = f"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
placed AS (
  SELECT doc_id, len(words) AS n_words, unnest(words) AS word, generate_subscripts(words, 1) AS place
  FROM listed),
run AS (
  SELECT doc_id, n_words, place,
         concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w,
                   lead(word, 4) OVER w) AS shingle
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
held AS (SELECT DISTINCT doc_id, shingle FROM run WHERE place <= greatest(n_words - 4, 1)),
sized AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT x, y FROM shared JOIN sized a ON x = a.doc_id JOIN sized b ON y = b.doc_id
  WHERE 100 * n_both >= 80 * (a.n + b.n - n_both)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT doc_id, y FROM reached JOIN linked ON other = x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sized s ON d.doc_id = s.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON d.doc_id = r.doc_id"""


FILTER_INTERACTIONS = """
WITH listed AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
failing AS (
  SELECT doc_id, part,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * len(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), FALSE) AS e
  FROM listed),
judged AS (
  SELECT part, a, b, c, d, e,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND toxic = 1) AS toxic
  FROM failing f),
cells AS (
  SELECT part, concat_ws('', CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
                         CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END) AS fails,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
places AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter,
         filter_order[:step - 1] AS before
  FROM orders, range(1, 6) AS steps(step)),
met AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails = letter AS alone,
         contains(fails, letter) AS hit,
         fails <> '' AND before <> '' AND regexp_matches(fails, '[' || before || '0]') AS gone
  FROM places, cells),
counted AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted"""


# A way through the pattern is a text: its cost in ten digits, then its edits, so that the
# least text is the cheapest way and the ASCII-least among equals; a tilde is no way at
# all. Ways are listed by state: nothing yet, system row, user row, assistant row.
def _dearer(way: str, more: str, edits: str) -> str:
    cost = f"lpad((left({way}, 10)::BIGINT + {more})::VARCHAR, 10, '0')"
    return f"CASE WHEN {way} = '~' THEN '~' ELSE {cost} || substr({way}, 11) || '{edits}' END"


_INSERTED = f"""[way[1], way[2],
  least(way[3], {_dearer("way[1]", "3", "I")}, {_dearer("way[2]", "3", "I")}, {_dearer("way[4]", "3", "I")}),
  least(way[4], {_dearer("way[1]", "6", "II")}, {_dearer("way[2]", "6", "II")}, {_dearer("way[3]", "3", "I")})]"""


def _ways_to(state: int, role: str, before: list[int]) -> str:
    """The least way to a state over one row: deleted there, or kept or given its role."""
    ways = [_dearer(f"o[{state}]", "4", "D")]
    for i in before:
        kept = _dearer(f"o[{i}]", "more", "K")
        ways.append(f"CASE WHEN stays AND initial = '{role}' THEN {kept} ELSE '~' END")
        if role != "s":
            ways.append(f"CASE WHEN stays THEN {_dearer(f'o[{i}]', '3 + more', 'R')} ELSE '~' END")
    return f"least({', '.join(ways)}, '~')"


CONVERSATION_REPAIR = f"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
spoiled AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS nth
  FROM spoiled),
marked AS (
  SELECT *, left(role, 1) AS initial,
         NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY nth) AS before
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(nth) AS n
  FROM marked GROUP BY conv_id),
ways AS (
  SELECT conv_id, 0::BIGINT AS nth, ['0000000000', '~', '~', '~'] AS way FROM counted
  UNION ALL
  SELECT conv_id, nth,
         [{_ways_to(1, "-", [])}, {_ways_to(2, "s", [1])}, {_ways_to(3, "u", [1, 2, 4])}, {_ways_to(4, "a", [3])}]
  FROM (SELECT w.conv_id, m.nth, m.initial, NOT (m.blank OR m.again) AS stays,
               CASE WHEN m.cut THEN 3 ELSE 0 END AS more, {_INSERTED} AS o
        FROM ways w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.nth = w.nth + 1)),
ended AS (
  SELECT c.*, {_INSERTED} AS o
  FROM counted c JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.nth = c.n),
best AS (SELECT *, left(least(o[1], o[4]), 10)::BIGINT AS cost, substr(least(o[1], o[4]), 11) AS audit FROM ended),
edits AS (
  SELECT conv_id, audit, i, audit[i] AS edit,
         len(translate(audit[:i], 'I', '')) AS nth,
         len(translate(audit[:i], 'D', '')) - 1 - len(translate(audit, 'D', '')) % 2 AS place
  FROM best, LATERAL (SELECT unnest(range(1, len(audit) + 1)) AS i)),
lines AS (
  SELECT e.conv_id, i,
         CASE WHEN edit = 'K' THEN p.role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN edit = 'I' THEN '' ELSE p.text END AS line
  FROM edits e LEFT JOIN placed p
    ON e.edit <> 'I' AND p.conv_id IS NOT DISTINCT FROM e.conv_id AND p.nth = e.nth
  WHERE edit <> 'D'),
hashed AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY i)) AS repaired_sha256 FROM lines GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN hashed h ON a.conv_id IS NOT DISTINCT FROM h.conv_id"""
