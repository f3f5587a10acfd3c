"""DuckDB counterparts of the registered queries."""

SQL: dict[str, str] = {}

SQL["op4_tree_merge_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER w = 1 AS kept
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r
"""

SQL["op9_threshold_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         coalesce(doc_id::VARCHAR, 'null') || '|' || md5(coalesce(text, '')) AS name,
         row_number() OVER (PARTITION BY source, name) - 1 AS occurrence,
         ('0x' || substr(md5('0|' || name || '|' || occurrence::VARCHAR), 1, 15))::BIGINT AS ticket
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn,
         [5, 2, 1][(turn % 3 + 1)::INT] AS weight, source_size * 3 AS cap,
         sum(source_size) OVER () AS total
  FROM s),
c AS (
  SELECT *, sum(cap) OVER f - cap AS caps_before,
         sum(weight) OVER () - sum(weight) OVER f + weight AS weight_left
  FROM w WINDOW f AS (ORDER BY cap / weight, turn ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE,
               weight * max((total - caps_before)::DOUBLE / weight_left::DOUBLE) OVER ()) AS target
  FROM c),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
         target - whole * source_size AS budget
  FROM t),
g AS (SELECT source, ticket, sum(size)::BIGINT AS words FROM d WHERE size > 0 GROUP BY ALL),
r AS (
  SELECT source, ticket, words,
         sum(words) OVER (PARTITION BY source ORDER BY ticket) AS upto
  FROM g),
k AS (
  SELECT r.source, r.ticket,
         upto <= budget OR (upto - words < budget AND upto - budget < budget - (upto - words)) AS more
  FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target,
       (d.size * (b.whole + CASE WHEN coalesce(k.more, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.ticket = k.ticket
"""

SQL["op6_revisit_resolution"] = r"""
WITH p AS (
  SELECT page_id,
         regexp_extract(url, '^[^/]*//[^/]*') || '/' || (page_id % 20)::VARCHAR AS url,
         ((page_id * 7919) % 100003) * 10 AS ts,
         '"' || md5(coalesce(html, '')) || '"' AS tag,
         strlen(coalesce(html, ''))::VARCHAR AS size
  FROM pages),
d AS (SELECT *, 'day ' || floor(ts / 1000)::BIGINT::VARCHAR AS day FROM p),
responses AS (
  SELECT page_id * 4 AS record_id, url, ts, CASE WHEN page_id % 5 <> 1 THEN tag END AS tag,
         day, size
  FROM d WHERE page_id % 17 <> 3),
visits AS (
  SELECT page_id * 4 + 1 AS record_id, url, ts + 5 AS ts,
         CASE WHEN page_id % 7 = 2 THEN '"other"' ELSE tag END AS bare,
         CASE WHEN page_id % 7 = 2 THEN '"other"' ELSE 'W/' || tag END AS tag,
         day || ' later' AS day, 'no-cache' AS cache
  FROM d
  UNION ALL
  SELECT page_id * 4 + 2, url, ts - 5, NULL, NULL, day, NULL FROM d),
latest AS (
  SELECT url, ts, max(record_id) AS record_id FROM responses GROUP BY ALL),
stored AS (SELECT r.* FROM responses r JOIN latest USING (url, ts, record_id)),
j AS (
  SELECT v.record_id, v.url, r.record_id AS response_id,
         CASE WHEN r.record_id IS NULL THEN 'no response'
              WHEN v.bare IS NOT NULL AND r.tag IS NOT NULL AND v.bare <> r.tag THEN 'mismatch'
              ELSE 'resolved' END AS outcome,
         v.cache, v.day, v.tag AS asked_tag, r.tag AS stored_tag, r.day AS stored_day, r.size
  FROM visits v ASOF LEFT JOIN stored r ON v.url = r.url AND v.ts > r.ts)
SELECT record_id, url, coalesce(response_id, -1) AS response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN concat_ws('|',
         'cache-control=' || cache, 'content-length=' || size, 'content-type=text/html',
         'date=' || day, 'etag=' || coalesce(asked_tag, stored_tag), 'last-modified=' || stored_day) END AS headers
FROM j
"""

TERMS = r"""regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL["op12_geometric_block_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {TERMS} AS terms FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, {TERMS} AS terms FROM benchmark),
q AS (SELECT DISTINCT item, item_id, unnest(terms) AS term FROM i),
c AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, greatest(sum(len(terms)), 1)::BIGINT AS n_terms FROM d),
p AS (
  SELECT row, doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY row, doc_id, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM p, c GROUP BY term, n_docs),
x AS (
  SELECT row, doc_id, term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))) AS share
  FROM p JOIN w USING (term), c),
s AS (
  SELECT item, item_id, row, doc_id, sum(share)::BIGINT AS score
  FROM q JOIN x USING (term) GROUP BY ALL HAVING sum(share) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
       doc_id, score
FROM s QUALIFY rank <= 10
"""

SQL["op13_threshold_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score
  FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.label <> p.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
