"""DuckDB SQL for the operators' queries that SQL can express on whole tables."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY 1
), weighted AS (
  SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight FROM sources
), leveled AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce((sum(most) OVER earlier)::DOUBLE, 0))
      / ((sum(weight) OVER ())::DOUBLE - coalesce((sum(weight) OVER earlier)::DOUBLE, 0)) AS level
  FROM weighted WINDOW earlier AS (ORDER BY most / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, coalesce(least(most::DOUBLE, weight * max(level) FILTER (most >= level * weight) OVER ()), 0) AS target FROM leveled
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), placed AS (
  SELECT doc_id, size, source_size, target, whole, round(target - whole * source_size)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, budget - below)))::BIGINT AS taken,
  CASE WHEN size = 0 THEN 0 ELSE least(3, whole + CASE WHEN below + size <= budget OR (below <= budget AND 2 * (budget - below) >= size) THEN 1 ELSE 0 END) END::INT AS copies
FROM placed
"""

DECONTAMINATION = r"""
WITH folded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), placed AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS win FROM placed
), doc_windows AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM folded, (SELECT DISTINCT n FROM windows))
), hits AS (
  SELECT doc_id, item_id, p, n FROM doc_windows JOIN windows USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM folded LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SHARDS = r"""
WITH crc AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), sized AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT + 1 AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM documents, crc
), placed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, (sum(size) OVER ())::BIGINT AS total
  FROM sized
), sharded AS (
  SELECT *, least(15, (2 * start + size) * 16 // (2 * total))::INT AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  NULL::INT AS grown_shard, start
FROM sharded
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE folded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM folded WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT doc_id, b FROM reach JOIN links ON r = a
), roots AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM roots LEFT JOIN sizes USING (doc_id)
"""

SECRETS = r"""
WITH docs AS (
  SELECT doc_id, source, CASE WHEN lang IS NULL THEN coalesce(source, '') ELSE concat_ws('/', source, lang) END AS repo, coalesce(text, '') AS t FROM documents
), kinds(kind, name) AS (
  VALUES (0, 'assign'), (1, 'access'), (2, 'hex'), (3, 'token')
), raw AS (
  SELECT doc_id, source, 0 AS kind, regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS m,
    string_split_regex(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS g FROM docs
  UNION ALL SELECT doc_id, source, 1, regexp_extract_all(t, 'AKIA[A-Z0-9]{14,}'), string_split_regex(t, 'AKIA[A-Z0-9]{14,}') FROM docs
  UNION ALL SELECT doc_id, source, 2, regexp_extract_all(t, '[0-9a-f]{16,}'), string_split_regex(t, '[0-9a-f]{16,}') FROM docs
  UNION ALL SELECT doc_id, source, 3, regexp_extract_all(t, '[A-Za-z0-9_-]{20,}'), string_split_regex(t, '[A-Za-z0-9_-]{20,}') FROM docs
), placed AS (
  SELECT doc_id, source, kind, m[i] AS match, (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM raw)
), valued AS (
  SELECT doc_id, source, kind, s, s + length(match) AS e,
    CASE WHEN kind = 0 THEN regexp_extract(match, '["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) ELSE match END AS v
  FROM placed
), kept AS (
  SELECT * FROM valued WHERE (kind = 0 AND length(v) >= 12) OR kind IN (1, 2)
    OR (kind = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]'))
), spans AS (
  SELECT * FROM kept k WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM kept b WHERE b.doc_id = k.doc_id AND b.kind < 3 AND b.s < k.e AND k.s < b.e)
), sizes AS (SELECT source, count(DISTINCT repo) AS n FROM docs GROUP BY 1),
held AS (SELECT v, source, count(DISTINCT repo) AS repos FROM spans JOIN docs USING (doc_id, source) GROUP BY 1, 2),
owners AS (
  SELECT v, count(*) > 2 OR bool_or(repos >= 3 AND 2 * repos > n) AS example FROM held JOIN sizes ON held.source IS NOT DISTINCT FROM sizes.source GROUP BY 1
), judged AS (
  SELECT doc_id, kind, s, e, example, (SELECT name FROM kinds p WHERE p.kind = spans.kind) || ':' || s || ':' || e AS label
  FROM spans JOIN owners USING (v)
), found AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(label, ',' ORDER BY s, kind) FILTER (kind < 3) AS base, string_agg(label, ',' ORDER BY s, kind) FILTER (kind < 3 OR NOT example) AS spans,
    count(*) FILTER (NOT example) AS n_live, count(*) FILTER (example) AS n_examples
  FROM judged GROUP BY 1
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples
FROM docs LEFT JOIN found USING (doc_id)
"""
