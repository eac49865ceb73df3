"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = r"""
WITH rules(verdict, h, p) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
           ('block', 'net', '/fr/')
), split AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
)
SELECT page_id, any_value(host) AS host, any_value(path) AS path, max_by(h || p, length(h || p)) AS rule,
       coalesce(max_by(verdict, length(h || p)), 'allow') AS verdict
FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id
"""

OP5 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
), reach(id, label) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT b, label FROM reach JOIN links ON id = a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(label) AS component_id, d.doc_id = min(label) AS kept
FROM documents d JOIN reach ON id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP8 = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '(?:[A-Za-z0-9]|[^\x00-\x7F])+') AS w FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '(?:[A-Za-z0-9]|[^\x00-\x7F])+') AS w FROM benchmark
), item_shingles AS (
    SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
        lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s
    FROM item_words WHERE len(w) > 0
), item_sizes AS (
    SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
), doc_shingles AS (
    SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
    FROM doc_words, (SELECT DISTINCT k FROM item_shingles)
), found AS (
    SELECT doc_id, item_id, count(*) AS c FROM doc_shingles JOIN item_shingles USING (k, s) GROUP BY 1, 2
), held AS (
    SELECT doc_id, count(*) AS n_items, list(item_id ORDER BY item_id) AS item_ids, max(c / n) AS containment
    FROM found JOIN item_sizes USING (item_id) WHERE 100 * c >= 80 * n GROUP BY doc_id
)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(item_ids, []) AS item_ids,
       coalesce(containment, 0.0) AS containment
FROM documents LEFT JOIN held USING (doc_id)
"""

OP9 = f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""

ORACLES = {"op3_url_filters": OP3, "op5_near_duplicates": OP5, "op8_contamination": OP8, "op9_exact_duplicates": OP9}
