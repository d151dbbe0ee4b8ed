"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP8 = r"""
WITH lines AS (
  SELECT doc_id, i, l,
         translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(s) AS l, generate_subscripts(s, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
), shared AS (
  SELECT key FROM lines WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE key IN (FROM shared)) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i)
                       FILTER (WHERE key NOT IN (FROM shared)), '')) AS kept_sha256
FROM lines GROUP BY doc_id
"""


OP2 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)
), cand AS (
  SELECT doc_id, p, n, list_slice(w, p, p + n - 1) AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM w, (SELECT DISTINCT n FROM win))
), hits AS (
  SELECT doc_id, p, c.n, item_id FROM cand c JOIN win ON win.n = c.n AND win.s = c.s
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP6 = r"""
WITH p AS (
  SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         ('0x' || substr(md5(coalesce(url, '')), 1, 8))::BIGINT % 365 AS day
  FROM pages
), names AS (
  SELECT DISTINCT host AS entry FROM p WHERE host <> ''
  UNION SELECT regexp_extract(host, '[^.]+\.[^.]+$') FROM p WHERE host <> ''
), e AS (
  SELECT entry, ('0x' || substr(md5(entry), 1, 8))::BIGINT AS h FROM names WHERE entry <> ''
), spans AS (
  SELECT entry, h // 3 % 3 AS k, h % 200 AS a, CASE WHEN h % 2 = 0 THEN h % 200 + 60 ELSE 99999 END AS b
  FROM e WHERE h % 3 = 0
  UNION ALL
  SELECT entry, h // 3 % 3, h % 200 + 120, 99999 FROM e WHERE h % 3 = 0 AND h % 4 = 0
), m AS (
  SELECT page_id, ['adult', 'malware', 'spam'][k + 1] AS list
  FROM p JOIN spans ON (host = entry OR ends_with(host, '.' || entry)) AND a <= day AND day < b
)
SELECT p.page_id, host, coalesce(lists, '') AS lists, coalesce(n, 0) AS n_entries, coalesce(n, 0) > 0 AS blocked
FROM p LEFT JOIN (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n FROM m GROUP BY page_id
) USING (page_id)
"""

OP7 = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
       sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM (SELECT *, CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000
                     THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) ELSE page_id END AS top
      FROM pages)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), trio AS (
  SELECT doc_id, i, hash_key, count(*) OVER (PARTITION BY doc_id, hash_key) AS n
  FROM (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
               unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS hash_key
        FROM d WHERE len(w) > 2)
), again AS (
  SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM trio WHERE n > 1) GROUP BY doc_id
), line AS (
  SELECT doc_id, source, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n_words,
         regexp_replace(translate(array_to_string(regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS key
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d)
), often AS (
  SELECT source, key FROM line WHERE n_words > 0
  GROUP BY source, key HAVING count(DISTINCT doc_id) > 10
), per_doc AS (
  SELECT doc_id,
         count(*) FILTER (WHERE n_words > 0) - count(DISTINCT l) FILTER (WHERE n_words > 0) AS n_dup_lines,
         count(*) FILTER (WHERE o.key IS NOT NULL) AS n_removed_lines,
         coalesce(sum(n_words) FILTER (WHERE o.key IS NOT NULL), 0) AS gone
  FROM line LEFT JOIN often o ON o.key = line.key AND o.source IS NOT DISTINCT FROM line.source
  GROUP BY doc_id
), m AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed,
         n_removed_lines, CAST(len(w) - gone AS BIGINT) AS n_left_words
  FROM d JOIN per_doc USING (doc_id) LEFT JOIN again USING (doc_id)
)
SELECT *, NOT base_failed AND n_left_words >= 20 AND 100 * (n_words - n_left_words) <= 50 * n_words AS kept
FROM m
"""

OP12 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same,
         CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
         p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT * FROM n WHERE rank <= 10
"""

# A state is (cost, edits, repaired rows); each row is taken by the states before it in turn.
OP13 = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
             lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
                             WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) % 20 AS k
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail
  FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS r,
         CASE WHEN tail = '' THEN 'blank' WHEN time > 1 THEN 'duplicate'
              WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed
), fold(conv_id, i, z0, z1, z2, z3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {'c': 0::BIGINT, 'a': '', 't': ''}, {'c': 1000000000::BIGINT, 'a': '', 't': ''},
         {'c': 3::BIGINT, 'a': 'I', 't': chr(10) || 'user:'},
         {'c': 6::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}
  FROM raw
  UNION ALL
  SELECT conv_id, i, n0, n1, c2, least(n3, {'c': c2.c + 3, 'a': c2.a || 'I', 't': c2.t || chr(10) || 'assistant:'})
  FROM (
    SELECT *, least(n2, {'c': x.c + 3, 'a': x.a || 'I', 't': x.t || chr(10) || 'user:'}) AS c2
    FROM (
      SELECT *, least(n0, n1, n3) AS x
      FROM (
        SELECT f.conv_id, j.i,
               {'c': z0.c + 4, 'a': z0.a || 'D', 't': z0.t} AS n0,
               least({'c': z1.c + 4, 'a': z1.a || 'D', 't': z1.t},
                     {'c': z0.c + IF(stay AND r = 's', more, 1000000000), 'a': z0.a || 'K', 't': z0.t || own}) AS n1,
               least({'c': z2.c + 4, 'a': z2.a || 'D', 't': z2.t},
                     {'c': w.c + IF(stay AND r = 'u', more, 1000000000), 'a': w.a || 'K', 't': w.t || own},
                     {'c': w.c + IF(stay, 3 + more, 1000000000), 'a': w.a || 'R', 't': w.t || chr(10) || 'user:' || text}) AS n2,
               least({'c': z3.c + 4, 'a': z3.a || 'D', 't': z3.t},
                     {'c': z2.c + IF(stay AND r = 'a', more, 1000000000), 'a': z2.a || 'K', 't': z2.t || own},
                     {'c': z2.c + IF(stay, 3 + more, 1000000000), 'a': z2.a || 'R', 't': z2.t || chr(10) || 'assistant:' || text}) AS n3
        FROM (SELECT *, least(z0, z1, z3) AS w FROM fold) AS f
        JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS stay, IF(fault = 'truncated', 3, 0) AS more,
                     chr(10) || role || ':' || text AS own FROM judged) AS j
          ON j.conv_id IS NOT DISTINCT FROM f.conv_id AND j.i = f.i + 1
      )
    )
  )
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
)
SELECT f.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       least(z0, z3).c AS cost, least(z0, z3).a AS audit, sha256(substr(least(z0, z3).t, 2)) AS repaired_sha256
FROM fold AS f LEFT JOIN stats AS s ON s.conv_id IS NOT DISTINCT FROM f.conv_id
WHERE f.i = coalesce(n, 0)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontamination": OP2,
        "op6_url_filters": OP6,
        "op7_warc": OP7,
        "op8_line_dedup": OP8,
        "op11_quality_rules": OP11,
        "op12_hard_negatives": OP12,
        "op13_conversation_repair": OP13,
    }
