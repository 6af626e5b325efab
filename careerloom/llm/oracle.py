"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op10_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {NORMAL} AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

SQL["op7_minhash_near_dedup"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(NORMAL)} AS w FROM documents),
s AS (
    SELECT doc_id, unnest(CASE
        WHEN len(w) >= 4 THEN list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END) AS shingle
    FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id
),
links AS (
    SELECT a, b FROM shared JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
    WHERE 100 * k >= 80 * (na.n + nb.n - k)
),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_ AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_ ON least_.a = d.doc_id
"""

SQL["op1_benchmark_decontamination"] = f"""
WITH i AS (SELECT item_id, {WORDS.format(NORMAL)} AS w FROM benchmark),
item AS (
    SELECT item_id, least(len(w), 5) AS width, unnest(list_distinct(
        [array_to_string(w[k:k + least(len(w), 5) - 1], ' ') FOR k IN range(1, len(w) - least(len(w), 5) + 2)]
    )) AS shingle
    FROM i WHERE len(w) > 0
),
size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
d AS (SELECT doc_id, {WORDS.format(NORMAL)} AS w FROM documents),
doc AS (
    SELECT DISTINCT doc_id, width, unnest(
        [array_to_string(w[k:k + width - 1], ' ') FOR k IN range(1, len(w) - width + 2)]
    ) AS shingle
    FROM d, (SELECT DISTINCT width FROM item)
    WHERE len(w) >= width
)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM doc JOIN item USING (width, shingle) JOIN size USING (item_id)
GROUP BY doc_id, item_id, n_item
HAVING 100 * count(*) >= 80 * n_item
"""

TERMS = rf"regexp_extract_all({NORMAL}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op12_divergence_quadtree"] = f"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k, {TERMS} AS w
    FROM documents
),
t AS (SELECT lang, source, k, unnest(w) AS term FROM d),
kept AS (
    SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 3
),
c AS (
    SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS c
    FROM t JOIN kept ON t.lang = kept.lang AND t.term = kept.term GROUP BY ALL
),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (
    SELECT o.lang, o.source, coalesce(s.n, 0)::HUGEINT AS n, coalesce(v.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM d) o
    LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) s ON s.lang = o.lang AND s.source = o.source
    LEFT JOIN v ON v.lang = o.lang
),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
           1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + g.v) AS p,
           1 + (1000000000::HUGEINT * (k.total + 1)) // (v.n + v.v) AS q
    FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
priced AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(priced.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN priced ON priced.lang = a.lang AND priced.source = a.source AND priced.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE c > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
