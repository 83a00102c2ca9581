"""SQL counterparts of the queries that SQL can express, over the same tables."""

OP2 = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), first AS (
    SELECT payload_digest, min(page_id) AS page_id FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id <> p.page_id THEN f.page_id END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM p LEFT JOIN first f ON p.payload_digest = f.payload_digest"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS words
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), places AS (
    SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
    SELECT p.doc_id, p.i, p.n, v.item FROM places p JOIN windows v ON p.n = v.n AND p.words = v.words
), words AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1
), items AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY 1
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(w.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.items, '')) AS items_sha256, coalesce(w.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words w ON d.doc_id = w.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id"""

OP5 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_slice(w, i, i + least(len(w), 2) - 1) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY 1, 2
), links AS (
    SELECT s.x, s.y FROM shared s JOIN sizes a ON a.doc_id = s.x JOIN sizes b ON b.doc_id = s.y
    WHERE 100 * s.n >= 80 * (a.n + b.n - s.n)
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM d
    UNION
    SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), components AS (
    SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY 1
)
SELECT c.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM components c LEFT JOIN sizes s ON s.doc_id = c.doc_id"""

OP12 = """
WITH rows AS (
    SELECT vec_id AS id,
           CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor, a.label AS own, r.id, r.label,
           CAST(list_sum(list_transform(list_zip(a.x, r.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM rows a JOIN rows r ON r.id <> a.id
    WHERE a.id % 100 = 0
), positives AS (
    SELECT anchor, own, id AS positive, score AS positive_score
    FROM scored WHERE own = label
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
)
SELECT p.anchor AS anchor_id, p.positive AS positive_id,
       CAST(row_number() OVER w AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor = p.anchor AND s.label <> p.own
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""
