"""The queries as DuckDB SQL. Patterns and limits are spelled out here, apart from the operators' own constants."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
tri AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM tri),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
places AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice),
repeats AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
judged AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    regexp_matches(line, '^\s*(?:[^|»›>•·]{{1,30}}\s*[|»›>•·]+\s*){{3,}}[^|»›>•·]{{0,30}}$')
    OR (length(line) <= 200 AND regexp_matches(line, '(?i)\b(?:all rights reserved|accept (?:all )?cookies|cookie policy|privacy policy|terms of (?:use|service)|enable javascript|click here|sign up for our newsletter|subscribe to our newsletter|share (?:this )?on|skip to (?:main )?content|lorem ipsum|log in|sign in)\b'))
    OR len(regexp_extract_all(line, '[^\p{{L}}\p{{M}}\p{{N}}\s]')) * 100 > length(regexp_replace(line, '\s+', '', 'g')) * 25
    OR regexp_matches(line, '(?:[!?]{{2,}}.*?){{3}}') AS fails
  FROM lines),
per_doc AS (
  SELECT doc_id, coalesce(sum(n) FILTER (fails), 0) AS lost,
    count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup
  FROM judged GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, dup AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, lost
  FROM d JOIN per_doc USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT lost * 100 > n_words * 40 AS kept
FROM v
"""

_ITEM_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP4 = rf"""
WITH items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
docs AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
item_starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s+n-1], ' ') AS t FROM item_starts),
sizes AS (SELECT DISTINCT n FROM windows),
doc_starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n),
doc_windows AS (SELECT doc_id, n, s, array_to_string(w[s:s+n-1], ' ') AS t FROM doc_starts),
found AS (SELECT d.doc_id, d.s, d.n, i.item_id FROM doc_windows d JOIN windows i ON d.t = i.t AND d.n = i.n),
places AS (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM found),
hits AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP8 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id, doc_id AS c FROM t
  UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.doc_id AND r.c < l.y),
least_id AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, c = t.doc_id AS kept
FROM t JOIN least_id USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS s
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT a, b AS p, s AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (
  SELECT p.a, p.p, p.ps, s.b, s.s, row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.s DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT same AND 30 * ps <= 100 * s.s AND 100 * s.s <= 90 * ps)
SELECT a AS anchor_id, p AS positive_id, rank::INTEGER AS rank, b AS negative_id, ps AS positive_score, s AS negative_score
FROM n WHERE rank <= 10
"""
