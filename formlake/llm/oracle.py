"""DuckDB SQL for the operators that SQL can express, over the driver's tables."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# exact Jaccard of all pairs that share a shingle, then the transitive closure of the links
NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce({_LOWER}, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y WHERE 100 * k >= 80 * (sx.n + sy.n - k)
),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN sides b ON b.x = r.y),
found AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id"""

# all 200-byte windows by their digest; hexadecimal text stands for bytes
SUFFIX_DEDUP = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 400)) AS w
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM bytes) s
),
repeated AS (SELECT doc_id, p FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
steps AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 200 THEN 0 ELSE 1 END AS fresh FROM repeated
),
runs AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 200 AS b FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT s.doc_id, s.run, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY run), 0) + 1,
    2 * (a - coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY run), 0))) AS before
  FROM spans s JOIN bytes USING (doc_id)
),
cut AS (
  SELECT s.doc_id, sum(s.b - s.a) AS n_removed, count(*) AS n_spans, max(s.b) AS tail, string_agg(g.before, '' ORDER BY s.run) AS head
  FROM spans s JOIN gaps g ON g.doc_id = s.doc_id AND g.run = s.run GROUP BY s.doc_id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)"""

# every document against every item that shares a term with it
RANKED_SEARCH = rf"""
WITH rows AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS t FROM documents),
tokens AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows),
tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM tokens GROUP BY r, doc_id, term),
lengths AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (r), corpus GROUP BY item_id, r, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

# base32 by groups of five hexadecimal digits, which are four letters; rows of equal id and payload differ by number
WARC = """
WITH rows AS MATERIALIZED (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS h FROM pages),
known AS (SELECT r, page_id, h, sha1(h) AS x FROM rows),
letters AS (
  SELECT r, page_id, octet_length(encode(h)) AS payload_bytes, array_to_string(list_transform(range(0, 8), lambda g:
    array_to_string(list_transform(range(0, 4), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(x, 5 * g + 1, 5) AS BIGINT) >> (15 - 5 * k)) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest
  FROM known
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, r) AS place,
    first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, r) AS best
  FROM letters
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN best END AS refers_to
FROM placed"""
