"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

ORACLES = {
    "op3_url_filter": """
WITH rules(action, rule_host, rule_path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT row_number() OVER () AS n, page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest),
best AS (
    SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(action, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (n)
""",
    "op7_exact_dedup": r"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM texts WINDOW w AS (PARTITION BY text_sha256)
""",
    "op11_angular_negatives": """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, br) AS k FROM s WHERE alike) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id NULLS LAST, s.br) AS k
  FROM p JOIN s USING (ar) WHERE NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
""",
    "op13_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
c AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM d GROUP BY r, term),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY r),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
i AS (SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
ic AS (SELECT q, any_value(item_id) AS item_id, term, count(*) AS times FROM i GROUP BY q, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM c, g WHERE term IN (SELECT term FROM ic) GROUP BY term, docs),
m AS (SELECT r, 100 - 75 + (75 * n * docs) // terms AS m FROM n, g),
s AS (SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM ic JOIN w USING (term) JOIN c USING (term) JOIN m USING (r) GROUP BY q, r),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS k FROM s WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM k WHERE k <= 10
""",
}
