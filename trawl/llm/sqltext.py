"""DuckDB twins of the queries that SQL can express."""

# A page's URL key, capture time and payload are the rules of warc_index in SQL.
WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % 31536000), '%Y%m%d%H%M%S') AS captured_at,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)', ['host', 'rest']) AS u
  FROM pages
), q AS (
  SELECT *, sha256(html) AS payload_digest, strlen(html) AS payload_bytes,
         CASE WHEN regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://')
              THEN array_to_string(list_reverse(string_split(lower(u.host), '.')), ',') || ')'
                   || CASE WHEN u.rest = '' THEN '/' ELSE u.rest END
              ELSE url END AS url_key
  FROM p
), r AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM q
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> least THEN least END AS refers_to,
       url_key, captured_at,
       row_number() OVER (ORDER BY url_key, captured_at, page_id) AS capture_no
FROM r
"""

REPEATS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 12), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)
), least AS (
  SELECT s, min(doc_id) AS first FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM win JOIN least USING (s) WHERE first < doc_id
), g AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(
         list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""

# Every term of every document; the ten best documents of an item by integer scores.
SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), g AS (
  SELECT count(*) AS nd, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), p AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, g GROUP BY term, nd
), s AS (
  SELECT q.item_id, p.r, p.doc_id,
         CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * g.nd) // g.l)))) AS BIGINT) AS score
  FROM p JOIN q ON p.term = q.term JOIN w ON w.term = p.term, g
  GROUP BY q.item_id, p.r, p.doc_id
), k AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""
