"""SQL with the same rows as the queries, for the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT p.page_id, payload_bytes, p.payload_digest,
       CASE WHEN p.page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > first_id THEN first_id END AS refers_to,
       CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN
         array_to_string(list_reverse(string_split(lower(regexp_extract(
           url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '.')), ',') || ')'
         || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)', 1)
         ELSE coalesce(url, '') END AS url_key
FROM p LEFT JOIN f USING (payload_digest)
"""

OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), sizes AS (
  SELECT DISTINCT least(len(w), 10) AS n FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n,
               unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), runs AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT runs.doc_id, runs.n, i, item_id FROM runs JOIN windows USING (n, s)
), words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP10 = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
), runs AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM runs)
  WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS pos FROM twice) GROUP BY 1
), c AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), k AS (
  SELECT *, n_words < 20 AS r1, 100 * n_repeat_words > 30 * n_words AS r2,
         10 * n_symbols > 3 * n_words AS r3, 100 * n_dup_lines > 30 * n_lines AS r4,
         (word_chars > 12 * n_words OR word_chars < 2 * n_words) AS r5 FROM c
), f AS (
  SELECT source, rule, count(*) AS n, sum(CAST(bad AS INT)) AS f
  FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([r1, r2, r3, r4, r5]) AS bad
        FROM k WHERE source IS NOT NULL) GROUP BY 1, 2
), s AS (
  SELECT rule, count(*) - 1 AS deg, sum(n) AS n, sum(n * n) AS nn, sum(f) / sum(n) AS p,
         sum(f * f / n) AS f2 FROM f GROUP BY 1
), m AS (
  SELECT rule, p, least(greatest(CASE WHEN p * (1 - p) > 0 AND n - nn / n - deg > 0
    THEN (f2 - n * p * p - p * (1 - p) * deg) / (p * (1 - p) * (n - nn / n - deg))
    ELSE 0.0001 END, 0.0001), 0.5) AS between_hosts FROM s
), h AS (
  SELECT source, max((f + p * (1 / between_hosts - 1)) / (n + 1 / between_hosts - 1)) AS rate
  FROM f JOIN m USING (rule) GROUP BY 1
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (r1 OR r2) AS base_failed, NOT (r1 OR r2) AND NOT coalesce(rate > 0.5, false) AS kept
FROM k LEFT JOIN h USING (source)
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), e AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e
), common AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), m AS (
  SELECT k.*, common.key IS NOT NULL AS dropped FROM k LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
"""

STATEMENTS = {
    "op1_external_index_merge": OP1,
    "op4_benchmark_decontamination": OP4,
    "op10_host_rules": OP10,
    "op12_line_dedup": OP12,
}
