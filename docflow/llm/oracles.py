"""DuckDB SQL for the queries of this package."""

from __future__ import annotations

from docflow.llm.quality import BOILERPLATE

WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]"

# A phrase of a lower-case line becomes one mark, and what parts words is doubled, so that two phrases do not share their border.
_MARK, _PARTS = "\ue000", r"[^\p{L}\p{N}_\x{E000}]"


def _phrases(phrase: str) -> str:
    """SQL for the characters, white space aside, of a phrase's whole-word occurrences in ``lower_line``."""
    marked = f"regexp_replace(replace(lower_line, '{phrase}', '{_MARK}'), '({_PARTS})', '\\1\\1', 'g')"
    return f"{len(''.join(phrase.split()))} * len(regexp_extract_all({marked}, '(^|{_PARTS}){_MARK}($|{_PARTS})'))"


_PHRASES = " + ".join(map(_phrases, BOILERPLATE))

LINE_FIRST_QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
),
tri AS (
  SELECT doc_id, i, struct_pack(a := words[i], b := words[i + 1], c := words[i + 2]) AS t
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)
),
twice AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
),
split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM w),
line AS (
  SELECT doc_id, k, ls[k] AS line, len(regexp_extract_all(ls[k], '{WORD}')) AS n,
         length(regexp_replace(ls[k], '{WHITE}', '', 'g')) AS chars
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM split)
),
phrased AS (
  SELECT *, CASE WHEN regexp_matches(lower_line, '{"|".join(BOILERPLATE)}') THEN {_PHRASES} ELSE 0 END AS phrase_chars
  FROM (SELECT *, lower(line) AS lower_line FROM line)
),
ranked AS (SELECT *, n > 0 AND row_number() OVER (PARTITION BY doc_id, line ORDER BY k) > 1 AS dup FROM phrased),
judged AS (
  SELECT *, n > 0 AND (dup
    OR 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > 20 * chars
    OR (regexp_matches(line, '[|•»]') AND 4 * len(regexp_extract_all(line, '[|•»]')) >= n)
    OR (len(regexp_extract_all(line, '[!?]')) > 1 AND 2 * len(regexp_extract_all(line, '[!?]')) >= n)
    OR (n >= 20 AND NOT regexp_matches(line, '[.!?,;:…。！？]'))
    OR (phrase_chars > 0 AND (n <= 10 OR 100 * phrase_chars >= 20 * chars))
  ) AS failed FROM ranked
),
totals AS (
  SELECT doc_id, sum(CASE WHEN dup THEN 1 ELSE 0 END) AS n_dup, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS n_lines,
         sum(CASE WHEN failed THEN 1 ELSE 0 END) AS n_failed, sum(CASE WHEN failed THEN 0 ELSE chars END) AS kept_chars,
         coalesce(string_agg(CASE WHEN failed THEN NULL ELSE line END, chr(10) ORDER BY k), '') AS clean
  FROM judged GROUP BY doc_id
),
base AS (
  SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '{WHITE}', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines,
       n_failed::BIGINT AS n_failed_lines, kept_chars::BIGINT AS kept_chars,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (word_chars - kept_chars) <= 50 * word_chars AS kept,
       sha256(clean) AS clean_sha256
FROM base JOIN totals USING (doc_id)
"""

DECONTAMINATION = r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT n FROM windows),
place AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM fold), lengths WHERE i + n - 1 <= len(w)
),
hit AS (SELECT doc_id, i, n, item_id FROM place JOIN windows USING (n, x)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM fold LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

FIXED_BLOCK_ANCHORS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
windows AS (
  SELECT doc_id, i, hash(list_slice(words, i, i + 34)) AS h, list_slice(words, i, i + 34) AS x
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)
),
often AS (SELECT h, x FROM windows GROUP BY h, x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN often USING (h, x))),
word AS (SELECT doc_id, p, words[p] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM w)),
marked AS (SELECT word.*, gone.p IS NOT NULL AS g FROM word LEFT JOIN gone USING (doc_id, p)),
turn AS (SELECT *, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM marked),
kept AS (
  SELECT doc_id, sum(CASE WHEN g THEN 1 ELSE 0 END) AS n_removed, sum(CASE WHEN opens THEN 1 ELSE 0 END) AS n_spans,
         string_agg(CASE WHEN g THEN NULL ELSE word END, ' ' ORDER BY p) AS t
  FROM turn GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM w LEFT JOIN kept USING (doc_id)
"""

# an edit changes the number of a letter by one at most
_LETTERS = "etnaios"
COUNTED = ", ".join(f"length(line) - length(replace(line, '{c}', '')) AS {c}" for c in _LETTERS)
NEAR = " AND ".join(f"abs(a.{c} - b.{c}) <= 2" for c in _LETTERS)

SEGMENT_LINE_DEDUP = rf"""
WITH RECURSIVE place AS (
  SELECT doc_id, k - 1 AS line_no, ls[k] AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
  WHERE regexp_matches(ls[k], '{WORD}')
),
known AS (SELECT line, length(line) AS n, {COUNTED}, min({{'doc': doc_id, 'line': line_no}}) AS first FROM place GROUP BY line),
link AS (
  SELECT a.line AS x, b.line AS y FROM known a JOIN known b ON b.n BETWEEN a.n - 2 AND a.n + 2 AND a.line <> b.line
  WHERE {NEAR} AND levenshtein(a.line, b.line) <= least(2, least(a.n, b.n) // 12)
),
reach AS (SELECT line AS x, line AS y FROM known UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
class AS (SELECT x AS line, min(first) AS least FROM reach JOIN known ON known.line = reach.y GROUP BY x),
degree AS (SELECT x AS line, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, line_no::BIGINT AS line_no, coalesce(n_links, 0)::BIGINT AS n_links, least.doc AS class_doc, least.line::BIGINT AS class_line,
       doc_id <> least.doc OR line_no <> least.line AS removed
FROM place JOIN class USING (line) LEFT JOIN degree USING (line)
"""

FILL_IN_MIDDLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
),
d AS (
  SELECT doc_id, text, unit, len(unit) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t
),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
),
p AS (
  SELECT *, array_to_string(unit[1:a], '') AS prefix, array_to_string(unit[a + 1:b], '') AS middle, array_to_string(unit[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

# checksum of the ASCII string s: a byte at a time, a bit at a time
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(s) + 1), lambda i: ascii(s[i])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))
  ), 4294967295)"""


def _steps() -> str:
    """Ways to use one row after up to two insertions: state (what was said last, ``-`` for nothing), letters, initial, next, cost."""
    after = {"-": "u", "s": "u", "u": "a", "a": "u"}
    rows = []
    for state in after:
        now, letters = state, ""
        for _ in range(3):
            ways = [("D", "", now, 3), ("R", "", after[now], 2), ("K", after[now], after[now], 0)]
            if now == "-":
                ways.append(("K", "s", "s", 0))
            rows += [(state, letters + letter, initial, then, 2 * len(letters) + cost) for letter, initial, then, cost in ways]
            now, letters = after[now], letters + "I"
    return ", ".join(map(str, rows))


CONVERSATION_REPAIR = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations
),
hit AS (SELECT *, {_CRC32} % 20 AS h FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE h <> 0
),
placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM damaged
),
row AS (
  SELECT *, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair
  FROM placed
),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM row GROUP BY conv_id
),
step(state, letters, initial, next, cost) AS (VALUES {_steps()}),
walk AS (
  SELECT conv_id, 0::BIGINT AS k, '-' AS state, 0::BIGINT AS cost, '' AS audit FROM counts
  UNION ALL
  SELECT conv_id, k, next, best.cost, best.audit FROM (
    SELECT w.conv_id, w.k + 1 AS k, s.next,
           min({{'cost': (w.cost + s.cost + CASE WHEN r.fault = 'truncated' AND right(s.letters, 1) <> 'D' THEN 1 ELSE 0 END)::BIGINT, 'audit': w.audit || s.letters}}) AS best
    FROM walk w JOIN row r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.k = w.k + 1 JOIN step s ON s.state = w.state
    WHERE s.initial IN ('', r.initial) AND (right(s.letters, 1) = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
    GROUP BY w.conv_id, w.k, s.next
  )
),
best AS (
  SELECT c.conv_id, min({{'cost': w.cost + CASE w.state WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END,
                         'audit': w.audit || CASE w.state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END}}) AS b
  FROM counts c JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.k = c.n GROUP BY c.conv_id
),
letter AS (
  SELECT conv_id, i, l, sum(CASE WHEN l = 'I' THEN 0 ELSE 1 END) OVER w AS k, sum(CASE WHEN l = 'D' THEN 0 ELSE 1 END) OVER w AS e
  FROM (SELECT conv_id, i, b.audit[i] AS l FROM (SELECT conv_id, b, unnest(range(1, len(b.audit) + 1)) AS i FROM best))
  WINDOW w AS (PARTITION BY conv_id ORDER BY i)
),
edit AS (
  SELECT letter.*, row.role, row.text, max(CASE WHEN e = 1 AND l = 'K' AND row.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY letter.conv_id) AS off
  FROM letter LEFT JOIN row ON row.conv_id IS NOT DISTINCT FROM letter.conv_id AND row.k = letter.k AND l <> 'I'
),
repaired AS (
  SELECT conv_id, sha256(coalesce(string_agg(
           CASE WHEN l = 'K' THEN role WHEN (e - 1 - off) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN l = 'I' THEN '' ELSE text END,
           chr(10) ORDER BY i), '')) AS h
  FROM edit WHERE l <> 'D' GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
       coalesce(b.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLE = {
    "op13_conversation_repair": CONVERSATION_REPAIR,
    "op12_seekable_fill_in_middle": FILL_IN_MIDDLE,
    "op2_segment_line_dedup": SEGMENT_LINE_DEDUP,
    "op10_fixed_block_anchors": FIXED_BLOCK_ANCHORS,
    "op4_suffix_array_decontamination": DECONTAMINATION,
    "op9_line_first_quality": LINE_FIRST_QUALITY,
}
