"""DuckDB's form of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from . import sharding

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Windows of 20 words in the order of (doc_id, start): all but the first of equal ones are repeats.
SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM d),
w AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 19 <= len(ws) THEN array_to_string(ws[i:i + 19], ' ') END AS t FROM p),
r AS (SELECT doc_id, i, word, t IS NOT NULL AND row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1 AS repeats FROM w),
c AS (SELECT doc_id, i, word, bool_or(repeats) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS cut FROM r),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE cut) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT cut), '') AS kept FROM c GROUP BY 1)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN k USING (doc_id)"""

#: Windows of 8 words of each item, or all words of a shorter one, against all windows of that length.
DECONTAMINATION = rf"""
WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER.format("text")}, '{_ALNUM}') AS ws FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
s AS (SELECT item, ws, least(8, len(ws)) AS n, unnest(generate_series(1, greatest(1, len(ws) - 7))) AS i FROM b WHERE len(ws) > 0),
q AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS t FROM s),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM d),
w AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS t FROM p, (SELECT DISTINCT n FROM q) WHERE i + n - 1 <= len(ws)),
h AS (SELECT DISTINCT doc_id, i, n, item FROM w JOIN q USING (n, t)),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM h) GROUP BY 1),
g AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id)"""

#: All pairs that share a shingle, confirmed on the whole sets, and what each document reaches over them.
NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACED}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS t FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
lowest AS (SELECT a AS doc_id, min(b) AS b FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN lowest USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": SUBSTRING_DEDUP, "op4_decontamination": DECONTAMINATION, "op8_near_dedup": NEAR_DEDUP, "op10_sharding": sharding.oracle_sql(40)}
