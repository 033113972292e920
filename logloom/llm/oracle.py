"""SQL of the queries that SQL can express, each written for itself."""

from __future__ import annotations

# CRC-32 of a text of letters up to U+00FF: its UTF-8 bytes, eight shifts for each.
_CRC = """
bytes AS (
  SELECT text, list_reduce(flatten([
      CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT] ELSE [(192 + unicode(c) // 64)::UBIGINT, (128 + unicode(c) % 64)::UBIGINT] END
      FOR c IN string_split(text, '')
    ]), lambda crc, byte: {rounds}, 4294967295::UBIGINT) AS crc
  FROM {texts}
),
sums AS (SELECT text, xor(crc, 4294967295::UBIGINT) AS crc FROM bytes)
"""


def _crc(texts: str) -> str:
    """``sums`` (text, crc) of the texts of a table ``texts``."""
    step = "xor(crc, byte)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda x: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))[1]"
    return _CRC.format(rounds=step, texts=texts)


OP11 = f"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
),
keys AS (SELECT DISTINCT key AS text FROM plain),
{_crc('keys')},
hurt AS (
  SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
    CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(body, '.!?', '') ELSE body END AS body,
    unnest(CASE WHEN crc % 20 = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM plain JOIN sums ON key = sums.text WHERE crc % 20 <> 0
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS n,
    regexp_extract(body, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last
  FROM hurt
),
faulted AS (
  SELECT *, CASE WHEN last = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, body ORDER BY n) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS following
  FROM numbered
),
counted AS (
  SELECT conv_id, count(*) AS rows,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulted GROUP BY conv_id
),
-- The last role given so far: n(one), s, u or a; what may follow by an edit, and what by keeping.
edits(state, edit, price, next, initial) AS (VALUES
  ('n', 'R', 2, 'u', NULL), ('s', 'R', 2, 'u', NULL), ('u', 'R', 2, 'a', NULL), ('a', 'R', 2, 'u', NULL),
  ('n', 'D', 3, 'n', NULL), ('s', 'D', 3, 's', NULL), ('u', 'D', 3, 'u', NULL), ('a', 'D', 3, 'a', NULL),
  ('n', 'K', 0, 's', 's'), ('n', 'K', 0, 'u', 'u'), ('s', 'K', 0, 'u', 'u'), ('u', 'K', 0, 'a', 'a'), ('a', 'K', 0, 'u', 'u')),
-- An inserted row before any row: one at most, as two lead back to where they began.
steps AS (
  SELECT state, edit, price, next, initial, '' AS put FROM edits
  UNION ALL
  SELECT i.state, 'I' || e.edit, 2 + e.price, e.next, e.initial, i.next
  FROM (VALUES ('n', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')) i(state, next) JOIN edits e ON e.state = i.next
),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, 'n' AS state, {{'cost': 0, 'audit': ''}} AS best FROM faulted
  UNION ALL
  SELECT w.conv_id, f.n, s.next,
    min({{'cost': w.best.cost + s.price + CASE WHEN fault = 'truncated' AND NOT ends_with(s.edit, 'D') THEN 1 ELSE 0 END,
         'audit': w.best.audit || s.edit}})
  FROM walk w JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
    JOIN steps s ON s.state = w.state AND (s.initial IS NULL OR s.initial = f.initial)
      AND (ends_with(s.edit, 'D') OR fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, f.n, s.next
),
ended AS (
  SELECT w.conv_id, min({{'cost': best.cost + 2 * length(more), 'audit': best.audit || more}}) AS best
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows = w.n
    JOIN (VALUES ('n', ''), ('s', 'II'), ('u', 'I'), ('a', '')) m(state, more) ON m.state = w.state
  GROUP BY w.conv_id
),
letters AS (
  SELECT conv_id, best, unnest(string_split(best.audit, '')) AS edit, generate_subscripts(string_split(best.audit, ''), 1) AS pos
  FROM ended
),
placed AS (
  SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY pos) AS n,
    count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY conv_id ORDER BY pos) AS kept
  FROM letters
),
-- Roles alternate; only a kept system row in front shifts them.
lines AS (
  SELECT p.conv_id, pos, kept, edit, f.role, CASE WHEN edit = 'I' THEN '' ELSE f.body END AS body,
    max(CASE WHEN edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS shift
  FROM placed p LEFT JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n AND edit <> 'I'
),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (kept - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || body, chr(10) ORDER BY pos) AS text
  FROM lines WHERE edit <> 'D' GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' ||
    translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
grouped AS (SELECT run, count(*) AS times FROM runs GROUP BY run),
keys AS (SELECT run AS text FROM grouped),
{_crc('keys')},
spelt AS (
  SELECT times, crc, split_part(run, ':', 2) AS word, CAST(crc % length(split_part(run, ':', 2)) AS BIGINT) AS place
  FROM grouped JOIN sums ON run = sums.text
),
written AS (
  SELECT times, CASE WHEN crc % 97 = 0 THEN word[:place] || word[place + 2:] ELSE word END AS word FROM spelt
),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
cuts AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
-- Another letter in the same place, or a letter less.
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, c.n, w.word, w.n FROM cuts c JOIN words w ON w.word = c.rest
  UNION
  SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest
),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'word': other}}) AS top FROM pairs GROUP BY word
),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top.less >= 2 * w.n THEN top.word END AS form, CASE WHEN -top.less >= 2 * w.n THEN -top.less END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
),
chains AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word JOIN forms r ON r.word = c.root AND r.form IS NULL
"""


OP4 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
usable AS (
  SELECT * FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(v, lambda x: x * x)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.95
),
reached AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION
  SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.vec_id, (SELECT count(*) FROM links l WHERE l.a = r.vec_id) AS n_links,
  min(other) AS component_id, min(other) = r.vec_id AS kept
FROM reached r GROUP BY r.vec_id
"""

OP9 = """
WITH whole AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM whole),
windows AS (
  SELECT doc_id, word, i, CASE WHEN count(*) OVER ahead = 13 THEN sha256(string_agg(word, ' ') OVER ahead) END AS h
  FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
),
firsts AS (SELECT h, min(doc_id) AS first FROM windows WHERE h IS NOT NULL GROUP BY h),
seen AS (
  SELECT w.doc_id, word, i, coalesce(first < w.doc_id, FALSE) AS again FROM windows w LEFT JOIN firsts f ON f.h = w.h
),
covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM seen
)
SELECT d.doc_id, count(word) AS n_words, count(word) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM whole d LEFT JOIN covered c ON c.doc_id = d.doc_id GROUP BY d.doc_id
"""


# The leftmost match of a pattern is the first place where its text stands: there the pattern would match, too.
OP10 = """
WITH RECURSIVE kinds(rank, kind, pattern, least) AS (VALUES
  (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
  (1, 'access', '(AKIA[A-Z0-9]+)', 20),
  (2, 'hex', '([0-9a-f]{24,})', 24)),
found AS (
  SELECT doc_id, rank, 0::BIGINT AS start, 0::BIGINT AS stop, text AS rest, '' AS hit FROM documents, kinds WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, rank, stop + strpos(rest, next) - 1, stop + strpos(rest, next) - 1 + length(next),
    substr(rest, strpos(rest, next) + length(next)), next
  FROM (SELECT f.doc_id, f.rank, f.stop, f.rest, regexp_extract(f.rest, k.pattern) AS next FROM found f JOIN kinds k ON k.rank = f.rank)
  WHERE next <> ''
),
spans AS (
  SELECT doc_id, f.rank, kind, start, stop FROM found f JOIN kinds k ON k.rank = f.rank
  WHERE hit <> '' AND length(regexp_extract(hit, pattern, 1)) >= least
),
listed AS (
  SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
    count(*) FILTER (WHERE rank = 2) AS n_hex,
    string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_embedding_near_dedup": OP4,
        "op9_substring_dedup": OP9,
        "op10_secret_scans": OP10,
        "op11_conversation_repair": OP11,
        "op13_spelling_variants": OP13,
    }
