"""SQL for the queries of this folder that SQL can express, over the test tables.

The others have none: spans that a test battery adds, models that are fitted, seeded shuffles and
packings, pseudonyms under a key. They are tested against brute force, round trips and held-out accuracy.
"""

from __future__ import annotations

_COMPONENTS = """
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS other FROM sides UNION SELECT r.node, s.b FROM reach AS r JOIN sides AS s ON r.other = s.a),
nearest AS (SELECT node, min(other) AS other FROM reach GROUP BY node)"""

SHINGLES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM grams AS x JOIN grams AS y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM shared JOIN sets AS p ON p.doc_id = a JOIN sets AS q ON q.doc_id = b WHERE 100 * o >= 75 * (len(p.s) + len(q.s) - o)),{_COMPONENTS}
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id FROM sets LEFT JOIN nearest ON node = doc_id"""

VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v AS x JOIN v AS y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.95),{_COMPONENTS},
degree AS (SELECT a, count(*) AS n FROM sides GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id, vec_id <= coalesce(other, vec_id) AS kept FROM v LEFT JOIN nearest ON node = vec_id LEFT JOIN degree ON a = vec_id"""

ORACLES = {"op2_shingle_join": SHINGLES, "op3_embedding_join": VECTORS}
