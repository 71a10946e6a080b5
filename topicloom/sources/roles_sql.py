"""The same role tables for DuckDB, as common table expressions in front of every oracle."""

ROLES = r"""
WITH meta_fields AS (
  SELECT r_name AS name, 0 AS level FROM region UNION ALL SELECT n_name, 1 FROM nation UNION ALL SELECT s_name, 2 FROM supplier
  UNION ALL SELECT 'L3 ' || p_brand, 3 FROM (SELECT DISTINCT p_brand FROM part)),
children AS (
  SELECT r_name AS parent_name, n_name AS child_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT n_name, 'L3 ' || p_brand FROM (SELECT DISTINCT p_brand FROM part)
    JOIN nation ON n_nationkey = CAST(substr(p_brand, 7) AS INT) - 1),
line_fields AS (
  SELECT l_orderkey AS doc, l_extendedprice AS w, r_name AS l0, n_name AS l1, s_name AS l2, 'L3 ' || p_brand AS l3
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
scores_long AS (
  SELECT 'd' || doc AS merged_id, level, name, round(sum(w) / sum(sum(w)) OVER (PARTITION BY doc, level), 4) AS score
  FROM (SELECT doc, 0 AS level, l0 AS name, w FROM line_fields UNION ALL SELECT doc, 1, l1, w FROM line_fields
        UNION ALL SELECT doc, 2, l2, w FROM line_fields UNION ALL SELECT doc, 3, l3, w FROM line_fields)
  GROUP BY doc, level, name),
order_meta AS (
  SELECT 'o' || o_orderkey AS id, 'd' || o_orderkey AS merged_id, CASE WHEN o_orderkey % 5 = 0 THEN 'fr' ELSE 'en' END AS lang, o_orderkey
  FROM orders),
new_scores AS (SELECT s.* FROM scores_long s JOIN order_meta m USING (merged_id) WHERE lang = 'en' AND o_orderkey % 3 <> 0),
prod_scores AS (SELECT s.* FROM scores_long s JOIN order_meta m USING (merged_id) WHERE lang = 'en' AND o_orderkey % 2 = 0),
edges AS (
  SELECT DISTINCT 'd' || l_orderkey AS merged_id, 'd' || ((l_orderkey * 7 + l_partkey) % (SELECT max(o_orderkey) + 1 FROM orders)) AS ref_id
  FROM lineitem),
sources AS (SELECT id AS orig_id, merged_id FROM order_meta WHERE o_orderkey % 97 <> 0),
doc_meta AS (
  SELECT 'x' || doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE substr(text, length(split_part(text, chr(10), 1)) + 2) END AS abstract,
    doc_id % 17 <> 0 AS title_ok, doc_id % 19 <> 0 AS abstract_ok,
    CASE WHEN doc_id % 13 = 0 THEN NULL ELSE upper(lang) END AS title_code, lang AS abstract_code FROM documents),
doc_sources AS (SELECT 'x' || doc_id AS orig_id, 'p' || (doc_id // 3) AS merged_id FROM documents),
vec_docs AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings)
"""
