"""The queries that SQL can express, for DuckDB; the others are tested against brute force."""

from __future__ import annotations

ORACLES = {
    "op1_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 3
    THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingles FROM words),
exploded AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM exploded x JOIN exploded y USING (shingle)
  WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets s ON s.doc_id = a JOIN sets t ON t.doc_id = b
  WHERE 100 * n >= 85 * (len(s.shingles) + len(t.shingles) - n)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, e.b FROM reached r JOIN ends e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)""",
    "op2_quality_rules": r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1),
    lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS w FROM words),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, i + 0 AS place FROM twice UNION ALL SELECT doc_id, i + 1 FROM twice UNION ALL SELECT doc_id, i + 2 FROM twice)
  GROUP BY doc_id),
m AS (
  SELECT words.doc_id, text, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS capitals, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters,
    length(text) - length(replace(text, '!!', ' ')) AS shouts
  FROM words LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words
    OR word_chars > 15 * n_words OR 2 * capitals > letters OR 5 * shouts > n_words OR 10 * letters < 6 * word_chars) AS kept
FROM b""",
    "op3_decontamination": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM items WHERE len(ws) > 0),
wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM sized),
have AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, CAST(len(ws) - n + 2 AS BIGINT))) AS i FROM docs, lengths WHERE len(ws) >= n)),
met AS (SELECT doc_id, i, n, item_id FROM have JOIN wanted USING (n, w)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id),
parts AS (
  SELECT n, w, list(DISTINCT CAST(item_id AS VARCHAR)) AS ids, string_split(w, ' ') AS pw, row_number() OVER () AS part FROM wanted GROUP BY n, w),
used AS (SELECT term, count(*) AS uses FROM (SELECT unnest(ws) AS term FROM docs) GROUP BY term),
rare AS (
  SELECT part, n, place, term FROM (SELECT part, n, unnest(range(0, n)) AS place, unnest(pw) AS term FROM parts)
  LEFT JOIN used USING (term)
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY coalesce(uses, 0), place) <= n // 5 + 2),
stand AS (SELECT doc_id, unnest(range(0, len(ws))) AS pos, unnest(ws) AS term FROM docs),
starts AS (
  SELECT doc_id, part, s FROM (
    SELECT doc_id, part, n, place, unnest(range(pos - place - 2, pos - place + 3)) AS s FROM stand JOIN rare USING (term))
  GROUP BY doc_id, part, n, s HAVING count(DISTINCT place) >= least(2, n)),
near AS (
  SELECT doc_id, unnest(ids) AS id FROM starts JOIN parts USING (part) JOIN docs USING (doc_id)
  WHERE len(list_filter(range(0, n), lambda k: s + k + 2 >= 0 AND list_contains(ws[greatest(s + k - 2, 0) + 1:s + k + 3], pw[k + 1]))) >= n - n // 5),
near_named AS (
  SELECT doc_id, count(*) AS n_near, string_agg(id, ',' ORDER BY id) AS near_ids FROM (SELECT DISTINCT doc_id, id FROM near WHERE id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, sha256(coalesce(near_ids, '')) AS near_sha256
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near_named USING (doc_id)""",
    "op7_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
f AS (SELECT page_id, n, sha256(body) AS d, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY body) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
}
