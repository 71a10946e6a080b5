"""DuckDB SQL for the engine's queries."""

from __future__ import annotations

import re

from topicloom.queries import PMC_PREFIX, PMID_PREFIX, URLS
from topicloom.sources.roles_sql import ROLES

CLEAN = r"trim(lower(regexp_replace(regexp_replace({0}, '([^[:alpha:]\s\d])|(\b\d+\b)', '', 'g'), '[\r\n\v\t]+', ' ', 'g')))"
#: Equal to the model cleaner where accents on letters are all that decomposes, as in these documents.
MODEL_CLEAN = (
    r"trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(regexp_replace(regexp_replace({0}, "
    r"'[\t\n\r\v\f\x{{200B}}\x{{2060}}\x{{FEFF}}]', ' ', 'g'), '[[:punct:]]', '', 'g')), '[^\x00-\x7F]', '', 'g')), '\b[0-9]+\b', '', 'g'), '[ \x1C-\x1F]+', ' ', 'g'))"
)
CORPUS = (
    ROLES
    + r"""
, marked AS (
  SELECT s.merged_id, m.id, title, abstract, (title IS NOT NULL AND coalesce(title_ok, false) AND lower(title_code) = 'en') AS has_title,
    (abstract IS NOT NULL AND coalesce(abstract_ok, false) AND lower(abstract_code) = 'en') AS has_abstract
  FROM doc_meta m JOIN doc_sources s ON s.orig_id = m.id),
best AS (
  SELECT merged_id, arg_max(title, (length(trim(title)), id)) FILTER (WHERE has_title) AS title,
    arg_max(abstract, (length(trim(abstract)), id)) FILTER (WHERE has_abstract) AS abstract
  FROM marked WHERE coalesce(has_title, false) OR coalesce(has_abstract, false) GROUP BY merged_id),
corpus AS (
  SELECT * FROM (SELECT merged_id, """
    + CLEAN.format("CASE WHEN title IS NULL THEN abstract WHEN abstract IS NULL THEN title ELSE title || '. ' || abstract END")
    + r""" AS text FROM best) WHERE length(text) > 0),
before AS (
  SELECT merged_id, CASE WHEN CAST(substr(merged_id, 2) AS BIGINT) % 6 = 0 THEN text || ' old' ELSE text END AS text
  FROM corpus WHERE CAST(substr(merged_id, 2) AS BIGINT) % 2 = 0),
counts AS (
  SELECT merged_id, term, count(*) AS tf
  FROM (SELECT merged_id, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS term FROM corpus) GROUP BY ALL),
dictionary AS (
  SELECT term AS mention, count(*) AS n FROM counts WHERE length(term) > 3 GROUP BY term
  HAVING count(*) * 20 >= (SELECT count(DISTINCT merged_id) FROM counts)),
mentions AS (
  SELECT merged_id, mention, count(*) AS n FROM (
    SELECT merged_id, unnest(regexp_extract_all(text, (SELECT string_agg(mention, '|' ORDER BY length(mention) DESC, mention) FROM dictionary))) AS mention
    FROM corpus) GROUP BY ALL)
"""
)
PIPE = (
    ROLES
    + """
, in_lang AS (SELECT DISTINCT s.merged_id FROM sources s JOIN order_meta m ON s.orig_id = m.id WHERE lang = 'en'),
combined AS (
  SELECT merged_id, name, score FROM new_scores
  UNION ALL SELECT merged_id, name, score FROM prod_scores
  WHERE merged_id NOT IN (SELECT merged_id FROM new_scores) AND merged_id IN (SELECT merged_id FROM in_lang)),
en_ids AS (SELECT DISTINCT merged_id FROM combined),
en_long AS (SELECT * FROM combined WHERE name NOT IN ('ASIA', 'CHINA')),
near AS (SELECT merged_id, ref_id AS neighbor_id FROM edges UNION SELECT ref_id, merged_id FROM edges),
neighbor AS (
  SELECT merged_id, neighbor_id FROM near
  WHERE merged_id NOT IN (SELECT merged_id FROM en_ids) AND neighbor_id IN (SELECT merged_id FROM en_ids)),
n_neighbors AS (SELECT merged_id, count(DISTINCT neighbor_id) AS n FROM neighbor GROUP BY merged_id),
observed AS (
  SELECT n.merged_id, name, avg(score) AS mean, count(DISTINCT neighbor_id) AS k
  FROM neighbor n JOIN en_long e ON n.neighbor_id = e.merged_id GROUP BY ALL),
imputed AS (
  SELECT merged_id, n AS neighbors_count, name, round(mean + 1e-9, 4) AS avg_neighbors_score, k AS neighbors_with_field_count,
    round(mean * (k / n) + 1e-9, 4) AS score
  FROM observed JOIN n_neighbors USING (merged_id)),
final_long AS (
  SELECT * FROM (SELECT merged_id, name, score, false AS is_imputed FROM en_long UNION ALL SELECT merged_id, name, score, true FROM imputed)
  WHERE merged_id IN (SELECT merged_id FROM sources)),
final_ids AS (
  SELECT * FROM (SELECT merged_id FROM en_ids UNION ALL SELECT DISTINCT merged_id FROM imputed) WHERE merged_id IN (SELECT merged_id FROM sources)),
ranked AS (
  SELECT * FROM (SELECT merged_id, level, name, score, row_number() OVER (PARTITION BY merged_id, level ORDER BY score DESC, name) AS field_rank
                 FROM final_long JOIN meta_fields USING (name) WHERE score > 0) WHERE field_rank <= 3),
hierarchy AS (
  SELECT parent_name AS normalized_name, parent_name AS display_name, p.level AS parent_level, child_name AS child_normalized_name,
    child_name AS child_display_name, c.level AS child_level
  FROM children JOIN meta_fields p ON parent_name = p.name JOIN meta_fields c ON child_name = c.name),
best AS (
  SELECT merged_id, level, name, score FROM (
    SELECT *, row_number() OVER (PARTITION BY merged_id, level ORDER BY score DESC, name DESC) AS r FROM scores_long) WHERE r = 1),
tops AS (
  SELECT merged_id, string_agg(name, '|' ORDER BY level, field_rank) AS names,
    max(name) FILTER (WHERE level = 0 AND field_rank = 1) AS top_l0, max(name) FILTER (WHERE level = 1 AND field_rank = 1) AS top_l1,
    max(name) FILTER (WHERE level = 2 AND field_rank = 1) AS top_l2, max(name) FILTER (WHERE level = 3 AND field_rank = 1) AS top_l3,
    coalesce(string_agg(name, '|' ORDER BY field_rank) FILTER (WHERE level = 0), '') AS top_3_l0,
    coalesce(string_agg(name, '|' ORDER BY field_rank) FILTER (WHERE level = 1), '') AS top_3_l1,
    coalesce(string_agg(name, '|' ORDER BY field_rank) FILTER (WHERE level = 2), '') AS top_3_l2,
    coalesce(string_agg(name, '|' ORDER BY field_rank) FILTER (WHERE level = 3), '') AS top_3_l3
  FROM ranked GROUP BY merged_id),
revisions AS (
  SELECT DISTINCT 'ASIA' AS parent_name, 'Rev ' || p_brand AS child_name, 1 AS level FROM part
  UNION ALL SELECT parent_name, child_name, 1 FROM children WHERE parent_name = 'ASIA' AND child_name = 'CHINA'),
both_scores AS (
  SELECT merged_id, name, coalesce(a.score, 0) AS score_a, coalesce(b.score, 0) AS score_b
  FROM (SELECT * FROM new_scores WHERE level <= 1 AND merged_id IN (SELECT merged_id FROM prod_scores WHERE level >= 1)) a
  FULL JOIN (SELECT * FROM prod_scores WHERE level >= 1 AND merged_id IN (SELECT merged_id FROM new_scores WHERE level <= 1)) b USING (merged_id, name))
"""
)
_KEY = "list_sum(list_transform(range(1, len({0}) + 1), lambda i: {0}[i] * {1}[i]))"
VEC = (
    ROLES
    + r"""
, long_vec AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding) AS x FROM vec_docs),
doc_len AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM long_vec GROUP BY vec_id),
doc_unit AS (SELECT vec_id, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END AS x FROM long_vec JOIN doc_len USING (vec_id)),
field_long AS (SELECT label, pos, avg(x) AS x FROM long_vec GROUP BY label, pos),
field_unit AS (SELECT label, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END AS x FROM field_long JOIN (SELECT label, sqrt(sum(x * x)) AS n FROM field_long GROUP BY label) USING (label)),
sim AS (SELECT vec_id, f.label, round(sum(d.x * f.x) + 1e-9, 4) AS similarity FROM doc_unit d JOIN field_unit f USING (pos) GROUP BY ALL),
three AS (SELECT vec_id, label, similarity AS a, round(similarity * 1.5 - 0.1 + 1e-9, 4) AS b, CASE WHEN vec_id % 3 <> 0 THEN 0.0 END AS c FROM sim)
"""
)
DOC_TERMS = (
    "WITH doc_counts AS (SELECT doc_id, source, term, count(*) AS tf FROM (SELECT doc_id, source, "
    r"unnest(list_filter(regexp_split_to_array(" + CLEAN.format("text") + r", '\s+'), lambda x: x <> '')) AS term FROM documents) GROUP BY ALL),"
    """
doc_raw AS (SELECT doc_id, term, tf * log2((SELECT count(DISTINCT doc_id) FROM doc_counts) / df) AS w
            FROM doc_counts JOIN (SELECT term, count(*) AS df FROM doc_counts GROUP BY term) USING (term)),
doc_w AS (SELECT doc_id, term, w / n AS w FROM doc_raw JOIN (SELECT doc_id, sqrt(sum(w * w)) AS n FROM doc_raw GROUP BY doc_id) USING (doc_id) WHERE w <> 0),
src AS (SELECT source, term, sum(tf) AS tf FROM doc_counts GROUP BY ALL),
src_raw AS (SELECT source, term, tf * log2((SELECT count(DISTINCT source) FROM src) / df) AS w
            FROM src JOIN (SELECT term, count(*) AS df FROM src GROUP BY term) USING (term)),
src_w AS (SELECT source, term, w / n AS w FROM src_raw JOIN (SELECT source, sqrt(sum(w * w)) AS n FROM src_raw GROUP BY source) USING (source) WHERE w <> 0)
"""
)
_PICK = "(SELECT string_agg({0}, '|' ORDER BY length({0}) DESC, {0}) FROM {1})"
TEXT_SCORES = (
    CORPUS
    + r"""
, v AS (SELECT mention, embedding FROM (SELECT mention, row_number() OVER (ORDER BY mention) - 1 AS vec_id FROM dictionary) JOIN vec_docs USING (vec_id)),
vl AS (SELECT mention AS term, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS x FROM v),
vu AS (SELECT term, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END AS x FROM vl JOIN (SELECT term, sqrt(sum(x * x)) AS n FROM vl GROUP BY term) USING (term)),
srcs AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS place FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
topics AS (SELECT place, source, upper(substr(source, 1, 1)) || substr(source, 2) AS name,
  CASE WHEN place < 3 THEN 0 WHEN place < 8 THEN 1 WHEN place < 14 THEN 2 ELSE 3 END AS level FROM srcs),
edges2 AS (SELECT u.name AS parent_name, t.name AS child_name FROM topics t
  JOIN topics u ON u.place = CASE WHEN t.place < 8 THEN (t.place - 3) % 3 ELSE (t.place - 8) % 5 + 3 END WHERE t.place >= 3),
tpages AS (SELECT source, arg_min(body, doc_id) AS text FROM (SELECT source, doc_id, """
    + CLEAN.format("text")
    + r""" AS body FROM documents WHERE lang = 'en') GROUP BY source),
fields AS (SELECT row_number() OVER (ORDER BY level, name) - 1 AS index, name, level, text FROM tpages JOIN topics USING (source) WHERE length(trim(text)) > 0),
both_texts AS (SELECT 'd' AS kind, merged_id AS id, text FROM corpus UNION ALL SELECT 'f', name, text FROM fields),
tc AS (SELECT kind, id, term, count(*) AS tf FROM (
  SELECT kind, id, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS term FROM both_texts) GROUP BY ALL),
tm AS (SELECT kind, id, mention AS term, count(*) AS n FROM (
  SELECT kind, id, unnest(regexp_extract_all(text, """
    + _PICK.format("mention", "dictionary")
    + r""")) AS mention FROM both_texts) GROUP BY ALL),
dense0 AS (SELECT kind, id, pos, sum(tf * x) AS x FROM tc JOIN vu USING (term) GROUP BY ALL),
entity0 AS (SELECT kind, id, pos, sum(n * x) AS x FROM tm JOIN vl USING (term) GROUP BY ALL),
dense AS (SELECT kind, id, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END AS x FROM dense0 JOIN (SELECT kind, id, sqrt(sum(x * x)) AS n FROM dense0 GROUP BY ALL) USING (kind, id)),
entity AS (SELECT kind, id, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END AS x FROM entity0 JOIN (SELECT kind, id, sqrt(sum(x * x)) AS n FROM entity0 GROUP BY ALL) USING (kind, id)),
sparse0 AS (SELECT kind, id, term, tf * log2((SELECT count(DISTINCT merged_id) FROM counts) / df) AS x
  FROM tc JOIN (SELECT term, count(*) AS df FROM counts GROUP BY term) USING (term)),
sparse AS (SELECT kind, id, term, x / n AS x FROM sparse0 JOIN (SELECT kind, id, sqrt(sum(x * x)) AS n FROM sparse0 GROUP BY ALL) USING (kind, id) WHERE x <> 0),
s1 AS (SELECT a.id, b.id AS name, sum(a.x * b.x) AS s FROM dense a JOIN dense b USING (pos) WHERE a.kind = 'd' AND b.kind = 'f' GROUP BY ALL),
s2 AS (SELECT a.id, b.id AS name, sum(a.x * b.x) AS s FROM sparse a JOIN sparse b USING (term) WHERE a.kind = 'd' AND b.kind = 'f' GROUP BY ALL),
s3 AS (SELECT a.id, b.id AS name, sum(a.x * b.x) AS s FROM entity a JOIN entity b USING (pos) WHERE a.kind = 'd' AND b.kind = 'f' GROUP BY ALL),
sims AS (SELECT c.merged_id AS id, f.name, f.level, round(coalesce(s1.s, 0) + 1e-9, 6) AS dense, round(coalesce(s2.s, 0) + 1e-9, 6) AS sparse, round(coalesce(s3.s, 0) + 1e-9, 6) AS entity
  FROM corpus c CROSS JOIN fields f LEFT JOIN s1 ON s1.id = c.merged_id AND s1.name = f.name LEFT JOIN s2 ON s2.id = c.merged_id AND s2.name = f.name
  LEFT JOIN s3 ON s3.id = c.merged_id AND s3.name = f.name),
mean3 AS (SELECT *, list_filter([dense, sparse, entity], lambda x: x >= 0 AND x <= 1) AS ok FROM sims),
avg3 AS (SELECT id, name, level, dense, sparse, entity, CASE WHEN len(ok) = 0 THEN 0 ELSE round(list_sum(ok) / len(ok) + 1e-9, 6) END AS score FROM mean3),
up3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, level ORDER BY score DESC, name) AS r FROM avg3 WHERE level <= 1) WHERE r <= 3),
hop2 AS (SELECT DISTINCT a.parent_name AS l0, a.child_name AS l1, b.child_name AS name FROM edges2 a JOIN edges2 b ON a.child_name = b.parent_name
  JOIN fields m ON a.parent_name = m.name AND m.level = 0),
open2 AS (SELECT DISTINCT p.id, hop2.name FROM up3 p JOIN up3 q ON p.id = q.id AND p.level = 0 AND q.level = 1 JOIN hop2 ON hop2.l0 = p.name AND hop2.l1 = q.name),
scored AS (SELECT id, level, name, score FROM avg3 WHERE level <= 1 UNION ALL SELECT a.id, a.level, a.name, a.score FROM avg3 a JOIN open2 USING (id, name) WHERE a.level >= 2),
terms AS (SELECT mention AS term, row_number() OVER (ORDER BY mention) - 1 AS place FROM dictionary),
cased AS (SELECT upper(substr(term, 1, 1)) || substr(term, 2) AS term, place FROM terms),
titled AS (SELECT t.place, t.name, p.text, CASE WHEN t.place % 7 <> 6 THEN a.term END AS title_1, b.term AS title_2, CASE WHEN t.place % 2 = 0 THEN c.term END AS title_3
  FROM topics t LEFT JOIN tpages p USING (source) LEFT JOIN cased a ON a.place = t.place LEFT JOIN cased b ON b.place - 20 = t.place LEFT JOIN cased c ON c.place - 40 = t.place),
titles AS (SELECT lower(title) AS mention, min(name) AS name FROM (SELECT name, unnest([title_1, title_2, title_3]) AS title FROM titled) WHERE title IS NOT NULL GROUP BY 1),
spoken AS (SELECT name AS own, lower(coalesce(title_1, '')) AS a, lower(coalesce(title_2, '')) AS b, lower(coalesce(title_3, '')) AS c,
  unnest(regexp_extract_all(lower(text), """
    + _PICK.format("mention", "titles")
    + r""")) AS mention FROM titled WHERE text IS NOT NULL AND coalesce(title_1, title_2, title_3) IS NOT NULL),
tvec AS (SELECT name, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS x FROM topics JOIN vec_docs ON place = vec_id)
"""
)


def _topic_vectors(others: bool) -> str:
    own = "WHERE mention NOT IN (a, b, c)" if others else ""
    return (
        TEXT_SCORES
        + f""", said AS (SELECT own, titles.name, count(*) AS n FROM (SELECT * FROM spoken {own}) JOIN titles USING (mention) GROUP BY ALL),
total AS (SELECT own, pos, sum(n * x) AS x FROM said JOIN tvec USING (name) GROUP BY ALL),
unit AS (SELECT own, pos, CASE WHEN n = 0 THEN 0 ELSE x / n END AS x FROM total JOIN (SELECT own, sqrt(sum(x * x)) AS n FROM total GROUP BY own) USING (own))
SELECT t.name, coalesce(title_1, title_2, title_3) AS title, CAST(p.pos AS INTEGER) AS pos, round(coalesce(unit.x, 0) + 1e-9, 4) AS value
FROM titled t CROSS JOIN (SELECT unnest(range(0, 64)) AS pos) p LEFT JOIN unit ON unit.own = t.name AND unit.pos = p.pos"""
    )


_URLS = "urls AS (SELECT url FROM pages UNION ALL SELECT unnest([" + ", ".join(f"'{u}'" for u in URLS) + "]))"
PARSED = (
    "WITH "
    + _URLS
    + r""",
parsed AS (
  SELECT url, regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), '^www\.', '') AS host,
    regexp_replace(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '^/', '') AS path,
    regexp_extract(coalesce(url, ''), '\?(?:[^#]*&)?doi=([^&#]+)', 1) AS doi
  FROM urls),
named AS (SELECT *, regexp_extract(path, '([^/]*)/*$', 1) AS name, regexp_extract(path, '([^/]*)$', 1) AS tail, regexp_extract(path, '^(.*?)/*[^/]*$', 1) AS parents FROM parsed)
"""
)
_REFS = """refs AS (
  SELECT 'r' || o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'doi' WHEN 1 THEN 'pmc' WHEN 2 THEN 'pmid' ELSE 's2' END AS id_type,
    CASE WHEN o_orderkey % 13 <> 0 THEN CASE o_orderkey % 4 WHEN 0 THEN '10.1000/' || o_custkey WHEN 1 THEN 'PMC' || o_custkey ELSE '' || o_custkey END END AS id_value
  FROM orders)"""


def _id_join(kind: str) -> str:
    key = {"doi": "'10.1000/' || c_custkey", "pmc": f"'PMC' || substr('{PMC_PREFIX}' || c_custkey, 43)", "pmid": f"substr('{PMID_PREFIX}' || c_custkey, 33)", "s2": "'' || c_custkey"}[kind]
    return f"""WITH {_REFS},
works AS (SELECT 'c' || c_custkey AS orig_id, {key} AS id_value FROM customer WHERE c_acctbal > 0),
srcs AS (SELECT 'c' || c_custkey AS orig_id, 'm' || (c_custkey // 2) AS merged_id FROM customer),
papers AS (SELECT 'm' || (c_custkey // 2) AS merged_id, min(c_name) AS title, min(CASE WHEN c_acctbal > 1000 THEN c_mktsegment END) AS abstract
           FROM customer GROUP BY c_custkey // 2)
SELECT DISTINCT refs.id, merged_id, coalesce(title, '') || ' ' || coalesce(abstract, '') AS text
FROM refs JOIN works USING (id_value) JOIN srcs USING (orig_id) JOIN papers USING (merged_id) WHERE id_type = '{kind}'"""


def _taxonomy(replace: bool) -> str:
    gone = "name NOT IN (SELECT child_name FROM children WHERE parent_name = 'ASIA')" if replace else "true"
    edge = "parent_name <> 'ASIA'" if replace else "true"
    return PIPE + f""", kept AS (SELECT * FROM meta_fields WHERE {gone})
SELECT 'meta' AS kind, name, CAST(level AS VARCHAR) AS other FROM kept
UNION ALL SELECT 'meta', child_name, '1' FROM revisions WHERE child_name NOT IN (SELECT name FROM kept)
UNION ALL SELECT 'edge', child_name, parent_name FROM children WHERE {edge}
UNION ALL SELECT 'edge', child_name, parent_name FROM revisions"""


def _full(a: str, b: str) -> str:
    return f"SELECT bool_and(x.k IS NOT NULL) AS in_first, bool_and(y.k IS NOT NULL) AS in_second FROM ({a}) x FULL JOIN ({b}) y ON x.k = y.k"


def lean(sql: str) -> str:
    """`sql` without the common table expressions that its result doesn't use."""
    if not sql.lstrip().upper().startswith("WITH"):
        return sql
    at, parts = sql.upper().index("WITH") + 4, []
    while True:
        name, start = re.match(r"\s*(\w+)\s+AS\s*\(", sql[at:], re.IGNORECASE), at
        if not name:
            break
        at += name.end()
        depth, quoted = 1, False
        while depth:
            quoted ^= sql[at] == "'"
            depth += 0 if quoted else (sql[at] == "(") - (sql[at] == ")")
            at += 1
        parts.append((name[1], sql[start:at].strip()))
        at += re.match(r"\s*,?", sql[at:]).end()
    rest, kept = sql[at:].strip(), []
    needed = rest
    for name, part in reversed(parts):
        if re.search(rf"\b{name}\b", needed):
            kept.append(part)
            needed += part
    return ("WITH " + ",\n".join(reversed(kept)) + "\n" if kept else "") + rest


def oracle_sql() -> dict[str, str]:
    return {name: lean(sql) for name, sql in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    o = {
        "corpus_clean_text": CORPUS + "SELECT * FROM corpus",
        "corpus_incremental": CORPUS + "SELECT * FROM corpus WHERE (merged_id, text) NOT IN (SELECT (merged_id, text) FROM before)",
        "corpus_limit": CORPUS + "SELECT * FROM corpus ORDER BY merged_id LIMIT 50",
        "prev_corpus_refresh": CORPUS
        + """, now AS (SELECT * FROM corpus WHERE CAST(substr(merged_id, 2) AS BIGINT) % 5 <> 0)
SELECT * FROM now UNION ALL SELECT * FROM before WHERE merged_id NOT IN (SELECT merged_id FROM now)
AND merged_id IN (SELECT merged_id FROM corpus WHERE CAST(substr(merged_id, 2) AS BIGINT) % 3 = 0)""",
        "en_scores": PIPE + "SELECT merged_id, name, score FROM en_long",
        "neighbor_scores": PIPE
        + "SELECT n.merged_id, neighbor_id, count(name) AS n_fields, max(score) AS best_score FROM neighbor n LEFT JOIN en_long e ON neighbor_id = e.merged_id GROUP BY ALL",
        "imputed_scores": PIPE + "SELECT * FROM imputed",
        "field_scores": PIPE + "SELECT * FROM final_long",
        "field_hierarchy": PIPE + "SELECT * FROM hierarchy",
        "top_fields": PIPE + "SELECT * FROM tops",
        "top_fields_exploded": PIPE + "SELECT merged_id, level, field_rank, name, score FROM ranked",
        "check_ids_in_top_fields": PIPE + "SELECT count(*) = 0 AS ok FROM final_ids WHERE merged_id NOT IN (SELECT merged_id FROM ranked)",
        "check_children_in_meta": PIPE
        + "SELECT count(*) = 0 AS ok FROM children WHERE parent_name NOT IN (SELECT name FROM meta_fields) OR child_name NOT IN (SELECT name FROM meta_fields)",
        "check_score_names_in_meta": PIPE + "SELECT count(*) = 0 AS ok FROM final_long WHERE name NOT IN (SELECT name FROM meta_fields)",
        "check_all_ids_scored": PIPE + "SELECT count(*) = 0 AS ok FROM prod_scores WHERE merged_id NOT IN (SELECT merged_id FROM new_scores)",
        "check_child_names": PIPE + _full("SELECT DISTINCT child_name AS k FROM children", "SELECT DISTINCT child_display_name AS k FROM hierarchy"),
        "check_parent_names": PIPE + _full("SELECT DISTINCT parent_name AS k FROM children", "SELECT DISTINCT display_name AS k FROM hierarchy"),
        "check_distinct_ids": PIPE + "SELECT count(DISTINCT merged_id) = count(merged_id) AS ok FROM final_ids",
        "check_ids_agree": PIPE + _full("SELECT merged_id AS k FROM en_ids UNION SELECT merged_id FROM imputed", "SELECT DISTINCT merged_id AS k FROM ranked"),
        "check_imputed_not_empty": PIPE + "SELECT count(*) > 0 AS ok FROM imputed",
        "check_neighbors_not_empty": PIPE + "SELECT count(*) > 0 AS ok FROM neighbor",
        "check_row_counts": PIPE + "SELECT (SELECT count(*) FROM children) = (SELECT count(*) FROM hierarchy) AS ok",
        "check_score_range": PIPE + "SELECT min(score) >= 0 AS min_score, max(score) <= 1 AS max_score FROM en_long",
        "taxonomy_checks": PIPE
        + r"""SELECT count(DISTINCT name) = count(name) AS names_unique,
  count(DISTINCT regexp_replace(lower(name), '\s', '', 'g')) = count(name) AS names_unique_folded,
  bool_and(coalesce(name = trim(name), false)) AS names_trimmed, bool_and(coalesce(name <> '', false)) AS names_filled,
  bool_and(name = array_to_string(list_transform(string_split(name, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')) AS names_cased,
  (SELECT bool_and(coalesce(parent_name <> '', false) AND coalesce(child_name <> '', false)) FROM children) AS ends_named,
  (SELECT bool_and(n = 1) FROM (SELECT count(*) AS n FROM children GROUP BY parent_name, child_name)) AS edges_unique,
  (SELECT count(*) = 0 FROM (SELECT parent_name AS k FROM children UNION SELECT child_name FROM children) WHERE k NOT IN (SELECT name FROM meta_fields)) AS ends_known,
  (SELECT count(*) = 0 FROM meta_fields WHERE name NOT IN (SELECT parent_name FROM children UNION SELECT child_name FROM children)) AS nodes_used,
  (SELECT bool_and(n = 1) FROM (SELECT count(DISTINCT level) AS n FROM children JOIN meta_fields ON parent_name = name GROUP BY child_name)) AS parents_level
FROM meta_fields""",
        "taxonomy_replace_children": _taxonomy(True),
        "taxonomy_append": _taxonomy(False),
        "taxonomy_fix_levels": PIPE
        + """, wide AS (SELECT parent_name, child_name FROM children UNION ALL SELECT 'EUROPE', s_name FROM supplier)
SELECT parent_name, child_name FROM wide LEFT JOIN meta_fields ON parent_name = name
WHERE NOT (coalesce(level, -1) = 0 AND child_name IN (SELECT child_name FROM wide JOIN meta_fields ON parent_name = name GROUP BY child_name HAVING count(DISTINCT level) > 1))""",
        "taxonomy_two_hop": PIPE
        + "SELECT a.parent_name AS l0, a.child_name AS l1, b.child_name AS descendant FROM children a JOIN children b ON a.child_name = b.parent_name",
        "constraint_lists": PIPE
        + """SELECT l0, l1, string_agg(d, '|' ORDER BY d) AS descendants FROM (
  SELECT DISTINCT a.parent_name AS l0, a.child_name AS l1, b.child_name AS d FROM children a JOIN children b ON a.child_name = b.parent_name
  JOIN meta_fields m ON a.parent_name = m.name AND m.level = 0) GROUP BY l0, l1""",
        "taxonomy_duplicates": PIPE + "SELECT child_name, count(*) AS n FROM children GROUP BY child_name HAVING count(*) > 1",
        "tokenize_counts": CORPUS + "SELECT * FROM counts",
        "tokenize_counts_vocabulary": CORPUS + "SELECT * FROM counts WHERE term IN (SELECT term FROM counts GROUP BY term HAVING count(*) >= 5)",
        "tfidf_vectors": CORPUS
        + """, raw AS (SELECT merged_id, term, tf * log2((SELECT count(DISTINCT merged_id) FROM counts) / df) AS w
  FROM counts JOIN (SELECT term, count(*) AS df FROM counts GROUP BY term) USING (term))
SELECT merged_id, term, round(w / n + 1e-9, 4) AS weight FROM raw JOIN (SELECT merged_id, sqrt(sum(w * w)) AS n FROM raw GROUP BY merged_id) USING (merged_id) WHERE w <> 0""",
        "sparse_cosine": DOC_TERMS + "SELECT doc_id, source, round(sum(d.w * s.w) + 1e-9, 4) AS similarity FROM doc_w d JOIN src_w s USING (term) GROUP BY ALL",
        "dense_norm": VEC + "SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(x + 1e-11, 6) AS value FROM doc_unit",
        "dense_cosine": VEC + "SELECT * FROM sim",
        "field_similarity_matrix": VEC + "SELECT a.label AS label_a, b.label AS label_b, round(sum(a.x * b.x) + 1e-9, 4) AS similarity FROM field_unit a JOIN field_unit b USING (pos) GROUP BY ALL",
        "score_mean": VEC + "SELECT vec_id, label, round((a + b + coalesce(c, 0)) / (CASE WHEN c IS NULL THEN 2 ELSE 3 END) + 1e-9, 3) AS score FROM three",
        "score_positive_mean": VEC
        + """SELECT vec_id, label, CASE WHEN a > 0 OR b > 0 THEN round((greatest(a, 0) + greatest(b, 0)) / ((a > 0)::INT + (b > 0)::INT) + 1e-9, 3) END AS score FROM three""",
        "score_unit_mean": VEC
        + """, ok AS (SELECT *, (a BETWEEN 0 AND 1)::INT AS x, (b BETWEEN 0 AND 1)::INT AS y, coalesce((c BETWEEN 0 AND 1)::INT, 0) AS z FROM three)
SELECT vec_id, label, CASE WHEN x + y + z = 0 THEN 0 ELSE round((a * x + b * y + coalesce(c, 0) * z) / (x + y + z) + 1e-9, 3) END AS score FROM ok""",
        "rank_top10_per_level": PIPE
        + """SELECT merged_id, level, name, score, r AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY merged_id, level ORDER BY score DESC, name) AS r FROM scores_long) WHERE r <= 10 AND score <> 0""",
        "constrained_scores": PIPE
        + """, t3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY merged_id, level ORDER BY score DESC, name) AS r FROM scores_long WHERE level <= 1) WHERE r <= 3),
hop AS (SELECT DISTINCT a.parent_name AS l0, a.child_name AS l1, b.child_name AS name FROM children a JOIN children b ON a.child_name = b.parent_name
        JOIN meta_fields m ON a.parent_name = m.name AND m.level = 0),
allowed AS (SELECT DISTINCT p.merged_id, hop.name FROM t3 p JOIN t3 q ON p.merged_id = q.merged_id AND p.level = 0 AND q.level = 1 JOIN hop ON hop.l0 = p.name AND hop.l1 = q.name),
own AS (SELECT merged_id, level, name, score FROM scores_long WHERE level <= 1
        UNION ALL SELECT s.merged_id, s.level, s.name, s.score FROM scores_long s JOIN allowed USING (merged_id, name) WHERE s.level >= 2)
SELECT merged_id, level, name, score, r AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY merged_id, level ORDER BY score DESC, name) AS r FROM own) WHERE r <= 10 AND score <> 0""",
        "vector_group_sum": VEC
        + """, s AS (SELECT label, pos, sum(x) AS x FROM long_vec GROUP BY ALL)
SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(x / n + 1e-9, 4) AS value FROM s JOIN (SELECT label, sqrt(sum(x * x)) AS n FROM s GROUP BY label) USING (label)""",
        "entity_mentions": CORPUS + "SELECT * FROM mentions",
        "entity_vectors": CORPUS
        + """, v AS (SELECT mention, embedding FROM (SELECT mention, row_number() OVER (ORDER BY mention) - 1 AS vec_id FROM dictionary) JOIN vec_docs USING (vec_id)),
s AS (SELECT merged_id, pos, sum(n * x) AS x FROM mentions JOIN (SELECT mention, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS x FROM v) USING (mention) GROUP BY ALL)
SELECT merged_id, CAST(pos AS INTEGER) AS pos, round(x / n + 1e-9, 4) AS value FROM s JOIN (SELECT merged_id, sqrt(sum(x * x)) AS n FROM s GROUP BY merged_id) USING (merged_id)""",
        "sentence_vectors": CORPUS
        + """, v AS (SELECT mention AS term, embedding FROM (SELECT mention, row_number() OVER (ORDER BY mention) - 1 AS vec_id FROM dictionary) JOIN vec_docs USING (vec_id)),
l AS (SELECT term, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS x FROM v),
u AS (SELECT term, pos, x / n AS x FROM l JOIN (SELECT term, sqrt(sum(x * x)) AS n FROM l GROUP BY term) USING (term)),
s AS (SELECT merged_id, pos, sum(tf * x) AS x FROM counts JOIN u USING (term) GROUP BY ALL)
SELECT merged_id, CAST(pos AS INTEGER) AS pos, round(x / n + 1e-9, 4) AS value FROM s JOIN (SELECT merged_id, sqrt(sum(x * x)) AS n FROM s GROUP BY merged_id) USING (merged_id)""",
        "py_preprocess": "SELECT doc_id, " + MODEL_CLEAN.format("text") + " AS text FROM documents",
        "constrained_scorer": TEXT_SCORES
        + """SELECT id AS merged_id, level, name, round(score + 1e-9, 4) AS score, r AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id, level ORDER BY score DESC, name) AS r FROM scored) WHERE r <= 10 AND score <> 0""",
        "score_variants": TEXT_SCORES
        + """SELECT id AS merged_id, name, round(score + 1e-9, 3) AS score, round(dense + 1e-9, 3) AS dense, round(sparse + 1e-9, 3) AS sparse, round(entity + 1e-9, 3) AS entity
FROM avg3 WHERE level <= 1""",
        "field_keys": TEXT_SCORES + "SELECT index, name, level FROM fields",
        "title_lookup": TEXT_SCORES + "SELECT mention, name FROM titles",
        "topic_entity_vectors": _topic_vectors(False),
        "topic_entity_vectors_of_others": _topic_vectors(True),
        "model_text": ROLES + "SELECT id, " + MODEL_CLEAN.format("coalesce(title, '') || ' ' || coalesce(abstract, '')") + " AS text FROM doc_meta",
        "labelled_texts": ROLES
        + "SELECT id, "
        + CLEAN.format("CASE WHEN title IS NULL THEN abstract WHEN abstract IS NULL THEN title ELSE title || '. ' || abstract END")
        + " AS text FROM doc_meta",
        "label_lists": "SELECT doc_id, unnest([lang, source]) AS label FROM documents",
        "citation_numbers": "SELECT doc_id, CAST(doc_id % 40 AS INTEGER) AS number FROM documents",
        "joined_pages": "SELECT p_partkey, ' ' || p_name || CASE WHEN p_size % 2 = 0 THEN ' ' || p_brand ELSE '' END || ' ' || p_type AS text FROM part",
        "case_field_name": r"""SELECT p_partkey, 'The ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')
  || ' of GPU-Based and eWLB (Text-to-Speech)' AS name FROM part""",
        "html_to_text": r"""WITH parts AS (SELECT page_id, list_transform(string_split(html, '<p>')[2:], lambda x: regexp_replace(split_part(split_part(x, '</p>', 1), '</article>', 1), '<[^>]*>', '', 'g')) AS p FROM pages),
plain AS (SELECT page_id, replace(replace(replace(replace(array_to_string(p, chr(10)), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text FROM parts)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\[\d+]', '', 'g'),
  '(?i)\[(quantify|which\?|according to whom\?|citation needed|verification needed|)]|This section needs additional citations for verification|Please help improve this article by adding citations to reliable sources in this section|Unsourced material may be challenged and removed|Find sources|Learn how and when to remove this template message', '', 'g') AS text FROM plain""",
        "reference_urls": """SELECT DISTINCT page_id, url FROM (SELECT page_id, replace(replace(unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)), '&quot;', '"'), '&amp;', '&') AS url FROM pages)
WHERE NOT starts_with(url, './')""",
        "reference_table": r"""SELECT DISTINCT page_id AS field, url, '' AS domain, CAST(NULL AS VARCHAR) AS id_type, CAST(NULL AS VARCHAR) AS id_value
FROM (SELECT page_id, replace(replace(unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)), '&quot;', '"'), '&amp;', '&') AS url FROM pages)""",
        "wiki_section_text": """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Lead of ' || page_id WHEN 1 THEN 'Lead of ' || page_id || chr(10) || 'cites and'
  ELSE 'Firstcites and' END AS text,
  CASE page_id % 4 WHEN 0 THEN '2' WHEN 1 THEN '' ELSE (page_id % 3) || ',7' END AS notes FROM pages""",
        "wiki_section_urls": """SELECT page_id, 'http://n' || unnest(CASE page_id % 4 WHEN 0 THEN [2] WHEN 1 THEN [0, 1, 2, 7] ELSE [page_id % 3, 7] END) || '.example/' || page_id AS url FROM pages""",
        "sampling_frame": CORPUS
        + """, frame AS (SELECT merged_id, CAST(year(o_orderdate) AS INTEGER) AS year FROM (SELECT merged_id FROM corpus UNION ALL SELECT merged_id FROM before)
  JOIN orders ON merged_id = 'p' || o_orderkey WHERE year(o_orderdate) BETWEEN 1990 AND 2030)
SELECT merged_id, year, row_number() OVER (PARTITION BY year ORDER BY md5(merged_id), merged_id) AS number FROM frame""",
        "labelled_sample": PIPE
        + """, own AS (SELECT f.merged_id, f.name, m.level, f.score FROM final_long f JOIN meta_fields m USING (name) WHERE NOT is_imputed AND level <= 1
  AND CAST(substr(merged_id, 2) AS HUGEINT) * 2654435761 % 4294967296 % 10 < 1),
texts AS (SELECT 'd' || o_orderkey AS merged_id, o_orderpriority AS title, CASE WHEN o_totalprice > 100000 THEN 'dear' END AS abstract
  FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderstatus <> 'P')
SELECT merged_id, title, abstract, string_agg(name, '|' ORDER BY level, name) AS names, count(*) AS n FROM own LEFT JOIN texts USING (merged_id) GROUP BY ALL""",
        "embeddings_jsonl_roundtrip": ROLES + "SELECT vec_id, label, CAST(unnest(range(0, len(embedding))) AS INTEGER) AS pos, unnest(embedding) AS value FROM vec_docs",
        "clean_field_name": r"SELECT p_partkey, trim(regexp_replace(regexp_replace('  ' || replace(p_name, ' ', ' ' || chr(9) || ' ') || '–to—x ', '[–—]', '-', 'g'), '\s+', ' ', 'g')) AS name FROM part",
        "wiki_bracket_clean": r"""SELECT page_id, regexp_replace(regexp_replace(url || '[12] scales.[Citation needed] Whereas [28][29] find sources []', '\[\d+]', '', 'g'),
  '(?i)\[(quantify|which\?|according to whom\?|citation needed|verification needed|)]|This section needs additional citations for verification|Please help improve this article by adding citations to reliable sources in this section|Unsourced material may be challenged and removed|Find sources|Learn how and when to remove this template message', '', 'g') AS text FROM pages""",
        "url_domain": PARSED + "SELECT url, host AS domain FROM parsed",
        "extract_id": PARSED
        + r""", kinds AS (SELECT *, CASE
  WHEN host = 'api.semanticscholar.org' AND path LIKE 'CorpusID:%' THEN 's2' WHEN host = 'pubmed.ncbi.nlm.nih.gov' THEN 'pmid'
  WHEN host = 'ncbi.nlm.nih.gov' AND path LIKE 'pmc%' THEN 'pmc'
  WHEN host IN ('doi.org', 'dx.doi.org', 'hdl.handle.net', 'doi.wiley.com', 'link.springer.com') THEN 'doi'
  WHEN host = 'worldcat.org' AND path LIKE '%oclc%' THEN 'oclc' WHEN host = 'worldcat.org' AND path LIKE '%issn%' THEN 'issn'
  WHEN host = 'ui.adsabs.harvard.edu' THEN 'ads' WHEN host = 'jstor.org' THEN 'doi' WHEN host = 'arxiv.org' THEN 'arxiv'
  WHEN host IN ('citeseerx.ist.psu.edu', 'aeaweb.org') AND doi <> '' THEN 'doi' END AS id_type FROM named)
SELECT url, id_type, CASE WHEN id_type IS NULL THEN NULL WHEN id_type = 's2' THEN replace(path, 'CorpusID:', '') WHEN id_type = 'arxiv' THEN regexp_replace(path, '^abs/', '')
  WHEN id_type <> 'doi' THEN name WHEN host = 'jstor.org' AND parents LIKE '%/%' THEN regexp_extract(parents, '([^/]*)$', 1) || '/' || tail
  WHEN host = 'jstor.org' THEN '10.2307/' || tail WHEN host IN ('citeseerx.ist.psu.edu', 'aeaweb.org') THEN url_decode(doi) ELSE url_decode(path) END AS id_value FROM kinds""",
        "match_flag_counts": f"""WITH {_REFS} SELECT k.id_value IS NOT NULL AS matched, count(*) AS n FROM (SELECT * FROM refs WHERE id_type = 'doi') r
  LEFT JOIN (SELECT '10.1000/' || c_custkey AS id_value FROM customer WHERE c_acctbal > 0) k ON r.id_value = k.id_value GROUP BY 1""",
        "coverage_counts": f"WITH {_REFS} SELECT count(DISTINCT id) AS n_keys, count(DISTINCT CASE WHEN length(id_value) > 0 THEN id END) AS n_covered FROM refs",
        "level_shares": PIPE
        + """SELECT 'top_l0' AS level, top_l0 AS name, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct FROM tops WHERE top_l0 IS NOT NULL GROUP BY top_l0
UNION ALL SELECT 'top_l1', top_l1, count(*), round(count(*) / sum(count(*)) OVER () * 100, 1) FROM tops WHERE top_l1 IS NOT NULL GROUP BY top_l1""",
        "share_diff_pre_post": PIPE
        + """, s AS (SELECT CAST(substr(merged_id, 2) AS BIGINT) % 2 AS half, name, round(count(*) / sum(count(*)) OVER (PARTITION BY half) * 100, 1) AS pct FROM best WHERE level = 1 GROUP BY half, name)
SELECT a.name, a.pct AS pct_pre, b.pct AS pct_post, round(b.pct - a.pct, 1) AS diff FROM s a JOIN s b USING (name) WHERE a.half = 0 AND b.half = 1""",
        "avg_rank_best": """WITH p AS (SELECT l_orderkey, l_linenumber, round(2.0 / (1.0 / l_quantity + 1.0 / (l_discount + 1)) + 1e-9, 2) AS score FROM lineitem)
SELECT * FROM p QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY score DESC) + (count(*) OVER (PARTITION BY l_orderkey, score) - 1) / 2 = 1""",
        "group_share_min_total": """WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL),
t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total FROM c)
SELECT *, round(n / total, 4) AS prop FROM t WHERE total >= 100""",
        "group_head5": """WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL)
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) <= 5""",
        "kth_best_field": PIPE + "SELECT merged_id, name, score FROM scores_long QUALIFY row_number() OVER (PARTITION BY merged_id ORDER BY score DESC, name) = 2",
        "best_field_per_level": PIPE + "SELECT * FROM best",
        "stratified_sample": "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY CAST(doc_id AS HUGEINT) * 2654435761 % 4294967296, doc_id) <= 1000",
        "hash_sample": "SELECT doc_id FROM documents WHERE CAST(doc_id AS HUGEINT) * 2654435761 % 4294967296 % 100 < 10",
        "confusion_counts": """WITH r AS (SELECT lang, quality = 1 AS a, n_chars > 500 AS p FROM documents JOIN labels USING (doc_id)),
c AS (SELECT lang, count_if(a AND p) AS tp, count_if(NOT a AND p) AS fp, count_if(a AND NOT p) AS fn, count_if(NOT a AND NOT p) AS tn FROM r GROUP BY lang)
SELECT lang, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 4) END AS recall FROM c""",
        "zero_fill_compare": PIPE + "SELECT * FROM both_scores",
        "agreement_alpha": PIPE
        + """, per AS (SELECT merged_id, count(*) AS items, count_if(score_a <> score_b) AS differ FROM both_scores GROUP BY merged_id),
sq AS (SELECT merged_id, sum(c * c) AS squares FROM (SELECT merged_id, v, count(*) AS c FROM (SELECT merged_id, score_a AS v FROM both_scores UNION ALL SELECT merged_id, score_b FROM both_scores) GROUP BY ALL) GROUP BY merged_id)
SELECT merged_id, CASE WHEN 4 * items * items > squares THEN round(1 - 2 * differ / ((4 * items * items - squares) / (2 * items - 1)), 2) END AS alpha FROM per JOIN sq USING (merged_id)""",
        "scores_jsonl_roundtrip": PIPE + "SELECT merged_id, name, score FROM new_scores",
        "clustered_write": PIPE + "SELECT * FROM best",
        "table_upsert": PIPE
        + """, ch AS (SELECT merged_id, level, name, 1.0::DOUBLE AS score FROM new_scores WHERE level = 0)
SELECT merged_id, level, name, score FROM prod_scores WHERE level = 0 AND (merged_id, name) NOT IN (SELECT (merged_id, name) FROM ch) UNION ALL SELECT * FROM ch""",
    }
    return o | {f"id_join_{k}": _id_join(k) for k in ("doi", "pmc", "pmid", "s2")}
