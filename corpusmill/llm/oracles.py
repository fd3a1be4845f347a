"""DuckDB SQL for the operators that SQL can express on whole tables. The others are held against brute force in tests/llm."""

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.vec_id = l.a
), parts AS (
  SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id
)
SELECT p.vec_id, coalesce((SELECT count(*) FROM links l WHERE l.a = p.vec_id), 0) AS n_links, component_id, p.vec_id = component_id AS kept FROM parts p
"""

OP10_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE concat_ws(' ', w[p], w[p + 1], w[p + 2], w[p + 3]) END AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(p) WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.root FROM reach r JOIN both_ways l ON r.doc_id = l.a
)
SELECT r.doc_id, coalesce(max(n), 0) AS n_shingles, min(root) AS component_id FROM reach r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""
