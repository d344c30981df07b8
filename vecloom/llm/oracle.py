"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE = {
    "op3_url_aliases": r"""
WITH RECURSIVE pages_at AS (
  SELECT page_id, html,
    CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(rest, '^[^/?#]*[^?#]*(\?[^#]*)', 1) AS query
  FROM pages_at),
tags AS (
  SELECT host, path, query, regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS link
  FROM (SELECT host, path, query, unnest(regexp_extract_all(html,
      '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')) AS tag FROM named WHERE host <> '')
  UNION ALL
  SELECT host, path, query, regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
  FROM (SELECT host, path, query, unnest(regexp_extract_all(html,
      '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')) AS tag FROM named WHERE host <> '')),
links AS (
  SELECT host, path, query, replace(link, '&amp;', '&') AS link,
    regexp_extract(replace(link, '&amp;', '&'), '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme,
    regexp_extract(path, '^(.*/)', 1) AS folder
  FROM tags WHERE link <> ''),
resolved AS (
  SELECT host, path, query,
    CASE WHEN lower(scheme) IN ('http', 'https') THEN link
         WHEN scheme <> '' THEN NULL
         WHEN starts_with(link, '//') THEN 'x:' || link
         WHEN starts_with(link, '/') THEN 'x://' || host || link
         WHEN starts_with(link, '?') THEN 'x://' || host || path || link
         WHEN starts_with(link, '#') THEN 'x://' || host || path || query
         ELSE 'x://' || host || (CASE folder WHEN '' THEN '/' ELSE folder END) || link END AS target
  FROM links),
targets AS (
  SELECT host, path, query, CASE WHEN strpos(coalesce(target, ''), '://') > 0
      THEN substr(target, strpos(target, '://') + 3) ELSE '' END AS rest FROM resolved),
ends AS (
  SELECT host, path, query, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS to_host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS to_path,
    regexp_extract(rest, '^[^/?#]*[^?#]*(\?[^#]*)', 1) AS to_query
  FROM targets),
all_paths AS (SELECT DISTINCT path FROM (SELECT path FROM named UNION ALL SELECT to_path FROM ends)),
plain_paths AS (
  SELECT path, CASE WHEN contains(path, '/.') THEN
      list_reduce(string_split(path, '/'), lambda done, segment: CASE segment WHEN '.' THEN done
        WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || segment END)
      || CASE WHEN regexp_matches(path, '/\.\.?$') THEN '/' ELSE '' END ELSE path END AS plain
  FROM all_paths),
edges AS (
  SELECT host || p.plain || query AS a, to_host || t.plain || to_query AS b
  FROM ends JOIN plain_paths p ON ends.path = p.path JOIN plain_paths t ON ends.to_path = t.path
  WHERE to_host <> ''),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
rules(rule, rule_host, rule_path, decision) AS (VALUES ('net/', 'net', '/', 'block'),
  ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'),
  ('org/fr/', 'org', '/fr/', 'allow')),
nodes AS (SELECT DISTINCT b AS node FROM reach),
node_rules AS (
  SELECT node, arg_max(decision, length(rule)) AS decision
  FROM nodes JOIN rules ON (regexp_extract(node, '^([^/?]*)', 1) = rule_host
      OR ends_with(regexp_extract(node, '^([^/?]*)', 1), '.' || rule_host))
    AND starts_with(regexp_extract(node, '^[^/?]*([^?]*)', 1), rule_path)
  GROUP BY node),
carried AS (
  SELECT a AS node, CASE WHEN bool_or(decision = 'allow') THEN 'allow' ELSE 'block' END AS verdict
  FROM reach JOIN node_rules ON b = node_rules.node GROUP BY a),
page_rules AS (
  SELECT n.host, n.path, arg_max(rule, length(rule)) AS rule, arg_max(decision, length(rule)) AS decision
  FROM (SELECT DISTINCT host, path FROM named) n JOIN rules
    ON (n.host = rule_host OR ends_with(n.host, '.' || rule_host)) AND starts_with(n.path, rule_path)
  GROUP BY n.host, n.path)
SELECT n.page_id, n.host, n.path, p.rule, coalesce(p.decision, c.verdict, 'allow') AS verdict
FROM named n JOIN plain_paths USING (path) LEFT JOIN page_rules p ON n.host = p.host AND n.path = p.path
LEFT JOIN carried c ON n.host <> '' AND n.host || plain_paths.plain || n.query = c.node
""",
    "op4_threshold_topk": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])) AS BIGINT) AS score
  FROM usable q JOIN usable x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
""",
    "op7_hyperplane_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(many.n, 0) AS n_links, least(e.vec_id, coalesce(lowest.b, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(lowest.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN many ON many.a = e.vec_id LEFT JOIN lowest ON lowest.a = e.vec_id
""",
    "op9_fm_index_dedup": r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS content
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM split WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text,
    count(gone.i) AS n_removed
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept ON split.doc_id = kept.doc_id
""",
    "op11_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents),
marked AS (
  SELECT *, min(doc_id) OVER (PARTITION BY content) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size
  FROM normal)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(content) AS text_sha256
FROM marked
""",
}
