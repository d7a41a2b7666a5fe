"""DuckDB SQL for the queries of the operators that SQL can express."""

OP1 = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM doc_words, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item, s, n FROM grams JOIN windows USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= 0.9 * a.norm * b.norm),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(v.vec_id, coalesce(m, v.vec_id)) AS component_id,
  v.vec_id <= coalesce(m, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = v.vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = v.vec_id
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws(':', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS digest FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n FROM d GROUP BY source),
w AS (SELECT source, n, [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 2 * n AS cap FROM s),
l AS (
  SELECT *, (sum(n) OVER () * 1.5 - coalesce(sum(cap) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT source, n, CASE WHEN level >= cap / weight THEN cap
    ELSE weight * (SELECT arg_min(level, cap / weight) FROM l WHERE level < cap / weight) END AS target FROM l),
r AS (SELECT *, CASE WHEN n > 0 THEN target / n ELSE 0 END AS rate FROM t),
draws AS (
  SELECT d.source, k, rate, n, target, size,
    CAST('0x' || substr(md5(concat_ws(':', CAST(k AS VARCHAR), digest)), 1, 6) AS BIGINT) / 16777216.0 AS u
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, range(32) AS seeds(k)),
seeds AS (
  SELECT source, arg_min(k, (diff, k)) AS seed FROM (
    SELECT source, k, abs(sum(CASE WHEN u < rate - floor(rate) THEN size ELSE 0 END) + floor(rate) * n - target) AS diff
    FROM draws GROUP BY source, k, rate, n, target) GROUP BY source)
SELECT doc_id, size, CAST(n AS BIGINT) AS source_size, target,
  CAST(size * (floor(rate) + CASE WHEN CAST('0x' || substr(md5(concat_ws(':', CAST(seed AS VARCHAR), digest)), 1, 6) AS BIGINT) / 16777216.0
    < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source JOIN seeds ON d.source IS NOT DISTINCT FROM seeds.source
"""

OP4 = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(6 + length(role || text) + 4 * (length(role || text) - length(replace(role || text, '&', '')))
    + 3 * (length(role || text) - length(replace(role || text, '<', '')) + length(role || text) - length(replace(role || text, '[', ''))
    + length(role || text) - length(replace(role || text, ']', '')))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP8 = r"""
SELECT page_id, CASE WHEN regexp_matches(md5(CAST(page_id AS VARCHAR)), '^0[0-3]') THEN 'damaged' ELSE 'missing' END AS fault,
  CAST(strlen('WARC/1.0') + strlen('WARC-Type: resource') + strlen('WARC-Date: 2024-01-01T00:00:00Z') + strlen('WARC-Record-ID: <urn:page:>')
    + strlen(CAST(page_id AS VARCHAR)) + strlen('WARC-Target-URI: ') + strlen(coalesce(url, '')) + strlen('Content-Type: text/html')
    + strlen('WARC-Block-Digest: sha256:') + 64 + strlen('Content-Length: ') + strlen(CAST(strlen(coalesce(html, '')) AS VARCHAR))
    + 2 * 9 + strlen(coalesce(html, '')) AS BIGINT) AS record_bytes
FROM pages WHERE regexp_matches(md5(CAST(page_id AS VARCHAR)), '^0[0-3]|^ff[0-3]')
"""

OP11 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  sha256('42:' || CAST(doc_id AS VARCHAR)) AS d FROM documents),
h AS (SELECT *, len(u) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
  CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM t),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 10
"""

OP13 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""

ORACLE_SQL: dict[str, str] = {"op11_fill_in_middle": OP11, "op12_hard_negatives": OP12, "op13_exact_topk": OP13,
                              "op8_warc_audit": OP8, "op4_chat_formatting": OP4, "op1_decontamination": OP1, "op2_embedding_dedup": OP2, "op5_mixing": OP5}
