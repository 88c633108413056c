"""DuckDB SQL for the queries that SQL can express over whole tables."""

_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TOKENS = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_BLANKS = f"regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+')"

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_TOKENS.format('text')} AS w FROM documents),
i AS (SELECT item_id, {_TOKENS.format('text')} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, w[p : p + least(13, len(w)) - 1] AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, w[p : p + n - 1] AS win
       FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, p, dw.n FROM dw JOIN iw USING (win)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_BLANKS.format('text')} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(g) AS g FROM (
        SELECT doc_id, w[p : p + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM w WHERE len(w) >= 5)
        UNION ALL SELECT doc_id, w AS g FROM w WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, low) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.doc_id WHERE r.low < e.b),
m AS (SELECT doc_id, min(low) AS low FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.low, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

ORACLES: dict[str, str] = {"op3_warc": WARC, "op6_decontamination": DECONTAMINATION, "op10_ngram_join": NGRAM_JOIN}
