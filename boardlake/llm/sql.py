"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), tri AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), often AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM tri) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT i + j) AS n FROM often, (VALUES (0), (1), (2)) AS o(j) GROUP BY r
), line AS (
  SELECT r, trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g')) AS body FROM (SELECT r, unnest(lines) AS x FROM w)
), judged AS (
  SELECT r, length(body) - gaps AS chars,
         regexp_matches(body, '[.!?…。！？]')
         AND NOT len(regexp_extract_all(body, '[!#*$%&|<>]')) * 3 > (gaps + 1) * 2
         AND NOT len(regexp_extract_all(body, '[|>»·]')) * 4 >= gaps + 1
         AND NOT regexp_matches(body, '(?i)lorem ipsum|javascript|cookie policy|accept (?:all )?cookies|privacy policy|terms of (?:use|service)|all rights reserved|licensed under|skip to (?:main )?content|click here|read more\b|subscribe to our') AS ok
  FROM (SELECT r, body, len(regexp_extract_all(body, ' ')) AS gaps FROM line)
), sums AS (
  SELECT r, sum(chars) AS chars, sum(CASE WHEN ok THEN 0 ELSE chars END) AS lost, sum(CASE WHEN ok THEN 0 ELSE 1 END) AS bad
  FROM judged GROUP BY r
), base AS (
  SELECT w.r, doc_id, len(ws) AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(lines) AS n_lines, coalesce(bad, 0)::BIGINT AS n_bad_lines, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM w LEFT JOIN rep ON w.r = rep.r LEFT JOIN sums ON w.r = sums.r
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost_chars <= word_chars * 0.4::DOUBLE AS kept, n_lines, n_bad_lines, lost_chars
FROM failed
"""

OP7 = r"""
WITH items AS (
  SELECT row_number() OVER () AS i, item_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^0-9a-zA-Z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS ws
  FROM benchmark
), widths AS (
  SELECT i, item_id, ws, least(len(ws), 5) AS width FROM items WHERE len(ws) > 0
), item_shingles AS (
  SELECT DISTINCT i, item_id, width, array_to_string(ws[k:k + width - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(ws) - width + 2)) AS k FROM widths)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^0-9a-zA-Z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS ws
  FROM documents
), doc_shingles AS (
  SELECT DISTINCT r, doc_id, width, array_to_string(ws[k:k + width - 1], ' ') AS s
  FROM (SELECT r, doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) AS k FROM docs, (SELECT DISTINCT width FROM widths))
), sizes AS (
  SELECT i, count(*) AS n FROM item_shingles GROUP BY i
)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment
FROM doc_shingles JOIN item_shingles USING (width, s) JOIN sizes USING (i)
GROUP BY r, doc_id, i, item_id, n HAVING count(*) >= 0.8::DOUBLE * n - 1e-9
"""

OP8 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), learnt AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         sum(length('<|turn|><|end|>') + 1 + length(role) + length(text)
             + len(regexp_extract_all(role, '[\\\[<\n]')) + len(regexp_extract_all(text, '[\\\[<]')))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM learnt
"""

OP10 = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fits AS (
  SELECT host, path, arg_max(struct_pack(r := h || p, v := verdict), (length(h || p), length(h))) AS best
  FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules ON (u.host = h OR suffix(u.host, '.' || h)) AND prefix(u.path, p)
  GROUP BY host, path
)
SELECT page_id, parts.host AS host, parts.path AS path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
FROM parts LEFT JOIN fits ON parts.host = fits.host AND parts.path = fits.path
"""

OP11 = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY rank <= 3
"""

# crc32 is linear: the register after L bytes is that of L zero bytes, exclusive or what each
# byte adds, which depends on its value and its distance from the end alone.
OP12 = r"""
WITH RECURSIVE bits(b, k, c) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), one AS (
  SELECT b, c FROM bits WHERE k = 8
), docs AS (
  SELECT row_number() OVER () AS r, false AS target, doc_id, text FROM documents
  UNION ALL
  SELECT -row_number() OVER (), true, NULL, text FROM benchmark
), ws AS (
  SELECT r, target, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM docs
), runs AS (
  SELECT r, target, array_to_string(ws[i:i + w - 1], ' ') AS f
  FROM (SELECT r, target, ws, w, unnest(range(1, len(ws) - w + 2)) AS i FROM ws, range(1, 4) AS v(w))
), found AS (
  SELECT r, target, f, count(*) AS n FROM runs GROUP BY ALL
), features AS (
  SELECT DISTINCT f, hex(encode(f)) AS h FROM found
), bytes AS (
  SELECT f, len(h) // 2 - i AS back, ('0x' || substr(h, 2 * i - 1, 2))::BIGINT AS b
  FROM (SELECT f, h, unnest(range(1, len(h) // 2 + 1)) AS i FROM features)
), longest AS (
  SELECT max(len(h) // 2) AS n FROM features
), adds(back, b, c) AS (
  SELECT 0, b, c FROM one
  UNION ALL
  SELECT back + 1, adds.b, xor(adds.c >> 8, one.c) FROM adds JOIN one ON one.b = adds.c & 255 WHERE back + 1 < (SELECT n FROM longest)
), zeros(n, c) AS (
  SELECT 0, 4294967295
  UNION ALL
  SELECT n + 1, xor(zeros.c >> 8, one.c) FROM zeros JOIN one ON one.b = zeros.c & 255 WHERE n < (SELECT n FROM longest)
), parts AS (
  SELECT f, max(back) + 1 AS n, bit_xor(adds.c) AS c FROM bytes JOIN adds USING (back, b) GROUP BY f
), bucket AS (
  SELECT f, xor(xor(parts.c, zeros.c), 4294967295) % 10000 AS bucket FROM parts JOIN zeros USING (n)
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE NOT target), 0) AS s, coalesce(sum(n) FILTER (WHERE target), 0) AS t
  FROM found JOIN bucket USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)
), sums AS (
  SELECT r, sum(n * gain)::BIGINT AS weight FROM found JOIN bucket USING (f) JOIN gains USING (bucket) WHERE NOT target GROUP BY r
), scored AS (
  SELECT doc_id, len(ws) AS n_words, len(ws) + greatest(len(ws) - 1, 0) + greatest(len(ws) - 2, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM ws LEFT JOIN sums USING (r) WHERE NOT target
), ranked AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place,
         count(*) FILTER (WHERE n_words >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""
