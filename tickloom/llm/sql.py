"""SQL of the queries that SQL can express."""

OP6 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ' ' || coalesce(md5(text), 'null')), 1, 15))::BIGINT AS h
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS ratio,
         (sum(source_size) OVER () * 150.0::DOUBLE / 100.0::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM totals
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         coalesce(least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(level, ratio) FROM levels WHERE ratio > level)), 2.0::DOUBLE * source_size) AS target
  FROM levels
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), by_hash AS (
  SELECT source, h, sum(size) AS size FROM sized GROUP BY source, h
), run AS (
  SELECT b.source, b.h, b.size, p.target - p.whole * p.source_size AS extra,
         sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h) AS upto
  FROM by_hash b JOIN parts p ON b.source IS NOT DISTINCT FROM p.source
), thresholds AS (
  SELECT source, arg_min(CASE WHEN extra - (upto - size) <= upto - extra THEN h ELSE h + 1 END, h) AS threshold
  FROM run WHERE extra > 0 AND upto > extra GROUP BY source
)
SELECT s.doc_id, s.source, s.size, p.source_size, p.target,
       p.whole + CASE WHEN s.h < t.threshold THEN 1 ELSE 0 END AS copies,
       s.size * (p.whole + CASE WHEN s.h < t.threshold THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN thresholds t ON s.source IS NOT DISTINCT FROM t.source
"""

OP4 = """
WITH payloads AS (
  SELECT page_id, sha1(encode(coalesce(html, ''))) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), typed AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS newest FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM typed
"""

OP1 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP2 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), places AS (
  SELECT r, unnest(range(1, len(words) - 33)) AS i FROM texts
), windows AS (
  SELECT p.r, p.i, sha256(array_to_string(t.words[p.i:p.i + 34], ' ')) AS h FROM places p JOIN texts t USING (r)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT r, list(DISTINCT k) AS ks FROM (SELECT r, unnest(range(i, i + 35)) AS k FROM repeated) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN ks IS NULL THEN words ELSE list_filter(words, lambda x, k: NOT list_contains(ks, k)) END, ' ')) AS kept_sha256
FROM texts LEFT JOIN gone USING (r)
"""

OP10 = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), places AS (
  SELECT r, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM texts WHERE len(words) > 0
), shingles AS (
  SELECT DISTINCT p.r, array_to_string(t.words[p.i:p.i + 2], ' ') AS s FROM places p JOIN texts t USING (r)
), sizes AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), common AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y WHERE 100 * c >= 90 * (a.n + b.n - c)
), reach AS (
  SELECT r AS x, r AS y FROM texts
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT t.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM texts t JOIN reach ON reach.x = t.r JOIN texts o ON o.r = reach.y LEFT JOIN sizes ON sizes.r = t.r
GROUP BY t.r, t.doc_id
"""
