"""DuckDB SQL for the registered queries, written from the operators' definitions."""

from __future__ import annotations

from vecloom.functions.text import WHITESPACE

_SPACES = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def _strip(text: str) -> str:
    return f"trim({text}, {_SPACES})"


def _micro(vector: str) -> str:
    return (
        f"array_to_string(list_transform({vector}, "
        "lambda x: CAST(round(x::DOUBLE * 1e6) AS BIGINT)), ',')"
    )


def _dot(left: str, right: str) -> str:
    return f"list_dot_product({left}::DOUBLE[], {right}::DOUBLE[])"


def _number(text_id: str, digits: int = 16) -> str:
    """Signed 64-bit number from the leading hex digits of SHA-256."""
    unsigned = f"('0x' || substr(sha256({text_id}), 1, {digits}))::UBIGINT::HUGEINT"
    return f"CAST(CASE WHEN {unsigned} > 9223372036854775807 THEN {unsigned} - 18446744073709551616 ELSE {unsigned} END AS BIGINT)"


_PARAGRAPHS = f"""
lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents),
paragraphs AS (
  SELECT doc_id || '_' || (row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1) AS paragraph_id,
         doc_id AS article_id, source AS article_title, {_strip('raw')} AS text
  FROM lines WHERE {_strip('raw')} <> '')"""

_VECTORS = """
vectors AS (
  SELECT (vec_id // 4) || '_' || (vec_id % 4) AS paragraph_id, vec_id // 4 AS article_id,
         'label ' || label AS article_title, embedding,
         CAST((vec_id // 4) % 4 AS INTEGER) AS shard_id
  FROM embeddings)"""

_SAMPLES = """
samples AS (
  SELECT paragraph_id AS query_id, embedding AS asked FROM vectors
  WHERE shard_id = (SELECT min(shard_id) FROM vectors)
  ORDER BY paragraph_id LIMIT 10)"""

_EVERY = "samples AS (SELECT paragraph_id AS query_id, embedding AS asked FROM vectors)"

_REQUESTS = "requests AS (SELECT 'b' || item_id AS query_id, text FROM benchmark)"


def _embed(name: str, source: str, key: str, dim: int = 64) -> str:
    """CTEs ending in ``name(key, vector)``: signed feature hashing of ``source.text``."""
    return f"""
{name}_tokens AS (
  SELECT {key}, unnest(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM {source}),
{name}_numbers AS (
  SELECT {key}, ('0x' || substr(md5(token), 1, 8))::BIGINT AS h FROM {name}_tokens WHERE token <> ''),
{name}_slots AS (
  SELECT {key}, h % {dim} AS slot,
         CAST(sum(CASE WHEN (h // {dim}) % 2 = 0 THEN 1 ELSE -1 END) AS DOUBLE) AS w
  FROM {name}_numbers GROUP BY ALL),
{name}_lengths AS (SELECT {key}, sqrt(sum(w * w)) AS length FROM {name}_slots GROUP BY {key}),
{name} AS (
  SELECT s.{key}, list(CAST(CASE WHEN n.length > 0 THEN coalesce(t.w, 0) / n.length ELSE 0 END AS FLOAT)
                       ORDER BY d.slot) AS vector
  FROM {source} s CROSS JOIN (SELECT unnest(range({dim})) AS slot) d
  LEFT JOIN {name}_slots t ON t.{key} = s.{key} AND t.slot = d.slot
  LEFT JOIN {name}_lengths n ON n.{key} = s.{key}
  GROUP BY s.{key})"""


def _ranked(pairs: str, k: int | str) -> str:
    """CTEs: ``ranked`` with the best ``k`` per query of a pair source having
    query_id, id and raw."""
    return f"""
scored AS (SELECT *, round(raw, 9) AS s FROM ({pairs})),
ranked AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER) AS rank
    FROM scored) WHERE rank <= {k})"""


_SAMPLE_PAIRS = f"""SELECT q.query_id, v.paragraph_id AS id, v.article_id, v.article_title, v.shard_id,
  {_dot('v.embedding', 'q.asked')} AS raw FROM samples q CROSS JOIN vectors v"""

_TOP10 = f"WITH {_VECTORS}, {_SAMPLES}, {_ranked(_SAMPLE_PAIRS, 10)}"

_EVERY10 = f"WITH {_VECTORS}, {_EVERY}, {_ranked(_SAMPLE_PAIRS, 10)}"

_TEXT_PAIRS = """SELECT q.query_id, p.paragraph_id AS id, p.article_title,
  list_dot_product(pv.vector::DOUBLE[], q.vector::DOUBLE[]) AS raw
  FROM asked q CROSS JOIN stored pv JOIN paragraphs p USING (paragraph_id)"""

_TEXT_SEARCH = (
    f"WITH {_PARAGRAPHS}, {_REQUESTS}, {_embed('stored', 'paragraphs', 'paragraph_id')}, "
    f"{_embed('asked', 'requests', 'query_id')}"
)

_PAIRS_AFTER = """
scaled AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x::DOUBLE * label AS FLOAT)) AS v FROM embeddings),
pairs AS (
  SELECT a.vec_id, list_dot_product(a.v::DOUBLE[], b.v::DOUBLE[]) AS dot,
         sqrt(list_dot_product(a.v::DOUBLE[], a.v::DOUBLE[])) * sqrt(list_dot_product(b.v::DOUBLE[], b.v::DOUBLE[])) AS lengths
  FROM scaled a JOIN scaled b ON b.vec_id = a.vec_id + 1),
cosines AS (SELECT vec_id, dot, CASE WHEN lengths > 0 THEN dot / lengths ELSE 0 END AS cosine FROM pairs)"""

_LSH = """
planes AS (
  SELECT t, b, list(CASE WHEN ('0x' || substr(md5(t || ':' || b || ':' || d), 1, 1))::INTEGER % 2 = 0
                         THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY d) AS plane
  FROM (SELECT unnest(range(4)) AS t) CROSS JOIN (SELECT unnest(range(4)) AS b)
  CROSS JOIN (SELECT unnest(range(64)) AS d) GROUP BY t, b),
cells AS (
  SELECT v.paragraph_id, p.t,
         sum(CASE WHEN round(list_dot_product(v.embedding::DOUBLE[], p.plane), 9) >= 0 THEN 1 << p.b ELSE 0 END) AS cell
  FROM vectors v CROSS JOIN planes p GROUP BY v.paragraph_id, p.t),
candidates AS (
  SELECT DISTINCT a.paragraph_id AS query_id, b.paragraph_id AS id
  FROM cells a JOIN cells b USING (t, cell))"""

_LSH_SAMPLE_PAIRS = f"""SELECT c.query_id, c.id, {_dot('v.embedding', 'q.asked')} AS raw
  FROM candidates c JOIN samples q USING (query_id) JOIN vectors v ON v.paragraph_id = c.id"""
_LSH_ALL_PAIRS = f"""SELECT c.query_id, c.id, {_dot('v.embedding', 'q.embedding')} AS raw
  FROM candidates c JOIN vectors q ON q.paragraph_id = c.query_id JOIN vectors v ON v.paragraph_id = c.id"""



def _probed(most: int) -> str:
    """Candidates of the nearest buckets of each table, so many of them."""
    return _LSH.rsplit("candidates AS", 1)[0] + f"""
projected AS (
  SELECT v.paragraph_id, p.t, p.b, list_dot_product(v.embedding::DOUBLE[], p.plane) AS x
  FROM vectors v JOIN samples s ON s.query_id = v.paragraph_id CROSS JOIN planes p),
probed AS (
  SELECT query_id, t, xor(cell, mask) AS cell, row_number() OVER (PARTITION BY query_id, t ORDER BY cost, mask) AS nth
  FROM (SELECT p.paragraph_id AS query_id, c.t, c.cell::BIGINT AS cell, m.mask,
               round(sum(CASE WHEN (m.mask >> p.b) & 1 = 1 THEN p.x * p.x ELSE 0 END), 9) AS cost
        FROM projected p JOIN cells c USING (paragraph_id, t) CROSS JOIN (SELECT unnest(range(16)) AS mask) m
        GROUP BY p.paragraph_id, c.t, c.cell, m.mask)),
candidates AS (
  SELECT DISTINCT a.query_id, b.paragraph_id AS id FROM probed a JOIN cells b ON a.t = b.t AND a.cell = b.cell
  WHERE nth <= {most})"""


_EVENT_QUANTILES = """
ordered AS (
  SELECT {groups}, {value} AS v,
         row_number() OVER (PARTITION BY {groups} ORDER BY {value}) - 1 AS position,
         count(*) OVER (PARTITION BY {groups}) AS n
  FROM {source}),
stats AS (
  SELECT {groups}, count(*) AS n, round(avg(v), 6) AS mean,
         max(CASE WHEN position = CAST(floor(n * 0.5::DOUBLE) AS BIGINT) THEN v END) AS p50,
         max(CASE WHEN position = CAST(floor(n * 0.95::DOUBLE) AS BIGINT) THEN v END) AS p95
  FROM ordered GROUP BY {groups})"""

_RUNS = """
runs AS (
  SELECT CAST(pow(2, user_id % 4) AS INTEGER) AS worker_count, value AS duration_s, event_type,
         CASE WHEN user_id % 4 = 0 THEN 'centralized' ELSE 'sharded' END AS mode
  FROM events)"""

_DOC_SEARCH = f"""WITH texts AS (SELECT doc_id, source, text FROM documents),
{_embed('stored', 'texts', 'doc_id')},
wanted AS (SELECT doc_id FROM documents),
{_ranked('''SELECT q.doc_id AS query_id, v.doc_id AS id, d.source AS title, d.text,
  list_dot_product(v.vector::DOUBLE[], q.vector::DOUBLE[]) AS raw
  FROM stored q JOIN wanted USING (doc_id) JOIN stored v ON v.doc_id <> q.doc_id
  JOIN documents d ON d.doc_id = v.doc_id''', 5)}"""

_PIECES = f"""
pieces AS (
  SELECT page_id, unnest(string_split_regex(html, '<[^>]*>')) AS piece,
         generate_subscripts(string_split_regex(html, '<[^>]*>'), 1) - 1 AS position
  FROM pages),
marked AS (SELECT *, {_strip('piece')} = '' AS blank FROM pieces)"""

_CHANGED = f"""
merged AS (
  SELECT paragraph_id, article_id,
         CASE WHEN article_title IN ('label 0', 'label 1', 'label 2') THEN 'version 2' ELSE article_title END AS article_title,
         shard_id FROM vectors
  UNION ALL
  SELECT paragraph_id || '_copy', article_id, article_title, shard_id FROM vectors)"""

_P = f"WITH {_PARAGRAPHS} "
_V = f"WITH {_VECTORS} "
_HITS = "query_id, rank, id, article_id, article_title, s AS score"
_SCORE = "s AS score"
_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_EMBEDDED_PARAGRAPHS = f"""WITH {_PARAGRAPHS}, {_embed('stored', 'paragraphs', 'paragraph_id')}
  SELECT p.paragraph_id, p.article_id, p.article_title, CAST(p.article_id % 4 AS INTEGER) AS shard_id,
         {_micro('s.vector')} AS vector
  FROM paragraphs p JOIN stored s USING (paragraph_id)"""
_SAMPLE_VECTORS = (
    f"WITH {_VECTORS}, {_SAMPLES} SELECT query_id AS paragraph_id, {_micro('asked')} AS vector FROM samples"
)
_TITLE = _strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")

ORACLE: dict[str, str] = {
    "a1_scan_paragraphs": _P + "SELECT * FROM paragraphs",
    "a2_scan_csv": _CUSTOMER,
    "a2_scan_csv_schema": _CUSTOMER,
    "a3_xml_articles": f"""SELECT CAST(doc_id AS VARCHAR) AS title, {_strip('text')} AS extract
        FROM documents WHERE {_strip('text')} <> ''""",
    "a3_xml_nested": f"""SELECT 'outer ' || doc_id AS title, 'first' AS extract FROM documents WHERE doc_id % 5 <> 0
        UNION ALL SELECT CAST(doc_id AS VARCHAR), {_strip('text')} FROM documents WHERE {_strip('text')} <> ''""",
    "a3_html_titles": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "a4_chunk_paragraphs": _P + "SELECT * FROM paragraphs",
    "a5_read_shard": _V + f"""SELECT paragraph_id, article_id, shard_id, {_micro('embedding')} AS vector
        FROM vectors WHERE shard_id = 1""",
    "a6_empty_shards": """SELECT CAST(s AS INTEGER) AS shard_id FROM (SELECT unnest(range(16)) AS s)
        WHERE s NOT IN (SELECT label % 16 FROM embeddings)""",
    "a7_discover_shards": "SELECT DISTINCT CAST(label % 16 AS INTEGER) AS shard_id FROM embeddings",
    "a8_load_store": _V + f"""SELECT paragraph_id, article_id, article_title, shard_id,
        CAST(len(embedding) AS INTEGER) AS dims, {_micro('embedding')} AS vector FROM vectors""",
    "a9_read_queries": _SAMPLE_VECTORS,
    "b1_partitioned_write": _V + f"""SELECT paragraph_id, article_id, shard_id,
        'shard_id=' || shard_id AS folder, {_micro('embedding')} AS vector FROM vectors""",
    "b2_sample_queries": _SAMPLE_VECTORS,
    "b3_save_id_map": _V + f"""SELECT {_number('paragraph_id')} AS vector_id, paragraph_id,
        '{{"article_id":' || article_id || ',"article_title":"' || article_title || '"}}' AS metadata_json
        FROM vectors""",
    "b4_append_metrics": """SELECT event_type AS stage, round(sum(value), 4) AS duration_s,
        round(count(*) / sum(value), 6) AS throughput, 'events/s' AS throughput_unit,
        w.worker_count, CAST(count(*) AS VARCHAR) AS num_rows
        FROM events CROSS JOIN (SELECT unnest([1, 2]) AS worker_count) w GROUP BY event_type, w.worker_count""",
    "b5_run_report": _V + """SELECT 'given' AS embedder, 4::BIGINT AS num_shards,
        (SELECT count(*) FROM vectors) AS num_paragraphs, shard_id::BIGINT AS shard_id,
        count(*) AS num_vectors, count(DISTINCT article_id) AS num_articles,
        CAST(sum(len(embedding)) * 4 AS BIGINT) AS raw_bytes FROM vectors GROUP BY shard_id""",
    "c1_project": _P + """SELECT paragraph_id, article_id, article_title,
        CAST(article_id % 4 AS INTEGER) AS shard_id, text FROM paragraphs""",
    "c2_shard_key": """SELECT doc_id, CAST(((doc_id % 4) + 4) % 4 AS INTEGER) AS shard_id,
        CAST(((-doc_id % 7) + 7) % 7 AS INTEGER) AS negative_key_shard, 0 AS single_shard FROM documents""",
    "c3_filter_equal": _CUSTOMER + " WHERE c_nationkey = 7",
    "c4_keep_texts": f"WITH {_PIECES} SELECT page_id, CAST(position AS INTEGER) AS position, {_strip('piece')} AS text FROM marked WHERE NOT blank",
    "c5_reject_blank": f"""WITH {_PIECES} SELECT page_id,
        CASE WHEN blank THEN 'Text cannot be empty' ELSE 'none' END AS error, count(*) AS n
        FROM marked GROUP BY page_id, blank""",
    "c6_exclude_self": f"""WITH {_VECTORS}, {_EVERY},
        {_ranked(_SAMPLE_PAIRS + ' WHERE v.paragraph_id <> q.query_id', 5)} SELECT {_HITS} FROM ranked""",
    "c7_limit_if_positive": """SELECT * FROM (SELECT c_custkey, c_name, 20 AS row_limit FROM customer
        ORDER BY c_custkey LIMIT 20) UNION ALL SELECT c_custkey, c_name, 0 FROM customer""",
    "c8_bounded_k": f"""{_P}, asked AS (SELECT 'b' || item_id AS query_id, item_id % 60 AS k FROM benchmark)
        SELECT query_id,
          CASE WHEN k BETWEEN 1 AND 50 THEN least(k, (SELECT count(*) FROM paragraphs)) ELSE 0 END AS n_results,
          CASE WHEN k NOT BETWEEN 1 AND 50 THEN 'k must be between 1 and 50' ELSE 'none' END AS error
        FROM asked""",
    "c9_skip_empty_batches": "SELECT lang, count(*) AS n, 64 AS dims FROM documents GROUP BY lang",
    "c10_preview": _CUSTOMER + " ORDER BY c_custkey LIMIT 10",
    "c11_numeric_id": _P + f"SELECT paragraph_id, {_number('paragraph_id')} AS vector_id FROM paragraphs",
    "c12_metadata_json": """SELECT doc_id,
        '{"source":"' || source || '","quality":' || coalesce(CAST(quality AS VARCHAR), 'null') || '}' AS metadata_json,
        source, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)""",
    "c13_empty_metadata": """SELECT doc_id, CASE WHEN quality IS NULL THEN 0 ELSE 2 END AS n_keys,
        coalesce(CAST(quality AS VARCHAR), 'none') AS quality FROM documents LEFT JOIN labels USING (doc_id)""",
    "c14_casts": f"""SELECT CAST(vec_id AS VARCHAR) AS id, CAST(vec_id % 4 AS INTEGER) AS shard_id,
        {_micro('list_transform(embedding, lambda y: CAST(y::DOUBLE / 3 AS FLOAT))')} AS vector FROM embeddings""",
    "c15_unit_vectors": f"""WITH scaled AS (SELECT vec_id,
          list_transform(embedding, lambda x: CAST(x::DOUBLE * label AS FLOAT)) AS v FROM embeddings),
        lengths AS (SELECT vec_id, v, sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])) AS length FROM scaled)
        SELECT vec_id, {_micro('list_transform(v, lambda y: CAST(CASE WHEN length > 0 THEN y::DOUBLE / length ELSE 0 END AS FLOAT))')} AS vector
        FROM lengths""",
    "c16_pair_scores": f"""WITH {_PAIRS_AFTER} SELECT vec_id, round(dot, 6) AS inner_product,
        round(cosine, 6) AS cosine FROM cosines""",
    "c17_similarity": f"""WITH {_PAIRS_AFTER} SELECT vec_id, round(cosine, 6) AS score,
        round(cosine, 6) AS score_from_euclidean FROM cosines""",
    "c18_length": "SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM documents",
    "c19_dims": """SELECT label, CAST(min(len(embedding)) AS INTEGER) AS least,
        CAST(max(len(embedding)) AS INTEGER) AS most, min(len(embedding)) = max(len(embedding)) AS agree
        FROM embeddings GROUP BY label""",
    "c20_alignment": """SELECT lang, count(*) AS n, count(*) - count(vec_id) AS n_incomplete
        FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY lang""",
    "c21_rounding": "SELECT event_id, round(value / 7, 4) AS four, round(value / 7, 2) AS two FROM events",
    "d1_score_blocks": f"{_TEXT_SEARCH}, {_ranked(_TEXT_PAIRS, 5)} SELECT query_id, rank, id, {_SCORE} FROM ranked",
    "d2_resolve_ids": f"""WITH {_VECTORS}, {_EVERY}, numbered AS (
          SELECT *, {_number('paragraph_id')} AS vector_id FROM vectors),
        {_ranked(f"SELECT q.query_id, v.vector_id AS id, v.paragraph_id, v.article_id, v.article_title, {_dot('v.embedding', 'q.asked')} AS raw FROM samples q CROSS JOIN numbered v", 10)}
        SELECT query_id, rank, paragraph_id,
          '{{"article_id":' || article_id || ',"article_title":"' || article_title || '"}}' AS metadata_json, {_SCORE}
        FROM ranked""",
    "d3_lookup_known": """SELECT doc_id, lang, source, n_chars FROM documents
        WHERE doc_id IN (SELECT o_custkey FROM orders)""",
    "d3_lookup_unknown": """SELECT DISTINCT o_custkey AS doc_id, 'doc_id ''' || o_custkey || ''' not found' AS error
        FROM orders WHERE o_custkey NOT IN (SELECT doc_id FROM documents)""",
    "d4_hydrate": f"""{_P} SELECT l.doc_id || '_' || l.quality AS id, l.quality,
          coalesce(p.article_title, 'missing') AS article_title, coalesce(p.text, 'missing') AS text
        FROM labels l LEFT JOIN paragraphs p ON p.paragraph_id = l.doc_id || '_' || l.quality""",
    "d4_hydrate_by_shard": f"""{_P} SELECT l.doc_id || '_' || l.quality AS id, l.doc_id AS article_id, l.quality,
          coalesce(p.article_title, 'missing') AS article_title, coalesce(p.text, 'missing') AS text
        FROM labels l LEFT JOIN paragraphs p ON p.paragraph_id = l.doc_id || '_' || l.quality
        WHERE l.doc_id % 4 IN (1, 3)""",
    "e1_count": _P + "SELECT count(*) AS n_paragraphs FROM paragraphs",
    "e2_filtered_count": "SELECT count(*) AS n FROM customer WHERE c_nationkey = 7",
    "e3_shard_stats": _V + """SELECT shard_id, count(*) AS num_vectors, count(DISTINCT article_id) AS num_articles,
        CAST(sum(len(embedding)) * 4 AS BIGINT) AS raw_bytes FROM vectors GROUP BY shard_id""",
    "e4_latency_stats": "WITH " + _EVENT_QUANTILES.format(groups="event_type", value="value", source="events")
        + " SELECT * FROM stats",
    "e5_throughput": """SELECT o_custkey, round(CASE WHEN s > 0 THEN n / s ELSE 0 END, 9) AS throughput FROM (
        SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS s
        FROM orders GROUP BY o_custkey)""",
    "e6_stored_size": _P + "SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes FROM paragraphs",
    "e7_collisions": _P + f"""SELECT {_number('paragraph_id', 4)} AS vector_id, count(*) AS n_ids
        FROM paragraphs GROUP BY 1 HAVING count(*) > 1""",
    "e8_worker_scaling": f"""WITH {_RUNS}, rated AS (
          SELECT event_type, worker_count, count(*) AS num_rows, count(*) / sum(duration_s) AS t
          FROM runs GROUP BY event_type, worker_count)
        SELECT event_type, worker_count, num_rows, round(t, 9) AS throughput,
          round(t / first_value(t) OVER (PARTITION BY event_type ORDER BY worker_count), 6) AS speedup,
          t = max(t) OVER (PARTITION BY event_type) AS is_peak FROM rated""",
    "e9_compare_settings": f"WITH {_RUNS}," + _EVENT_QUANTILES.format(
        groups="event_type, mode", value="duration_s", source="runs") + """
        SELECT c.event_type, c.mean AS centralized_mean, c.p50 AS centralized_p50, c.p95 AS centralized_p95,
          s.mean AS sharded_mean, s.p50 AS sharded_p50, s.p95 AS sharded_p95
        FROM (SELECT * FROM stats WHERE mode = 'centralized') c
        FULL JOIN (SELECT * FROM stats WHERE mode = 'sharded') s USING (event_type)""",
    "f1_longest": """SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM documents
        ORDER BY length(text) DESC, doc_id LIMIT 20""",
    "f2_exact_topk": f"{_TOP10} SELECT {_HITS} FROM ranked",
    "f2_exact_topk_cosine": f"""WITH {_VECTORS}, {_EVERY}, {_PAIRS_AFTER},
        {_ranked('''SELECT q.query_id, v.vec_id AS id, CASE WHEN list_dot_product(v.v::DOUBLE[], v.v::DOUBLE[]) > 0
          THEN list_dot_product(v.v::DOUBLE[], q.asked::DOUBLE[])
            / (sqrt(list_dot_product(v.v::DOUBLE[], v.v::DOUBLE[])) * sqrt(list_dot_product(q.asked::DOUBLE[], q.asked::DOUBLE[])))
          ELSE 0 END AS raw FROM samples q CROSS JOIN scaled v''', 10)}
        SELECT query_id, rank, id, {_SCORE} FROM ranked""",
    "f3_shard_merge": f"{_TOP10} SELECT {_HITS}, shard_id FROM ranked",
    "f4_k_beyond_corpus": f"""WITH {_REQUESTS}, names AS (SELECT r_regionkey AS id, r_name AS text FROM region),
        {_embed('asked', 'requests', 'query_id')}, {_embed('stored', 'names', 'id')},
        {_ranked('''SELECT q.query_id, s.id, list_dot_product(s.vector::DOUBLE[], q.vector::DOUBLE[]) AS raw
          FROM asked q CROSS JOIN stored s''', 10)}
        SELECT query_id, rank, id, {_SCORE} FROM ranked""",
    "f6_lsh_topk": f"""WITH {_VECTORS}, {_EVERY}, {_LSH}, {_ranked(_LSH_SAMPLE_PAIRS, 10)}
        SELECT query_id, rank, id, {_SCORE} FROM ranked""",
    "f6_lsh_topk_cells": f"""WITH {_VECTORS}, {_LSH}, {_ranked(_LSH_ALL_PAIRS, 10)}
        SELECT query_id, rank, id, {_SCORE} FROM ranked""",
    "f6_ivf_topk": f"""WITH {_VECTORS}, {_EVERY}, parts AS (
          SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
        means AS (SELECT label, d, avg(x) AS m FROM parts GROUP BY label, d),
        centres AS (SELECT label, list(m ORDER BY d) AS centre, sum(m * m) / 2 AS half FROM means GROUP BY label),
        near AS (
          SELECT v.paragraph_id, c.label, row_number() OVER (
            PARTITION BY v.paragraph_id
            ORDER BY list_dot_product(v.embedding::DOUBLE[], c.centre) - c.half DESC, c.label) AS place
          FROM vectors v CROSS JOIN centres c),
        candidates AS (
          SELECT q.paragraph_id AS query_id, o.paragraph_id AS id
          FROM near q JOIN near o ON o.label = q.label AND q.place <= 4 AND o.place = 1),
        {_ranked(_LSH_SAMPLE_PAIRS, 10)} SELECT query_id, rank, id, {_SCORE} FROM ranked""",
    "f6_ivf_all_cells": f"{_EVERY10} SELECT query_id, rank, id, {_SCORE} FROM ranked",
    "f7_recall": f"""{_EVERY10}, {_LSH},
        near AS (SELECT * FROM (
          SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 9) DESC, id) AS place
          FROM ({_LSH_SAMPLE_PAIRS})) WHERE place <= 10)
        SELECT r.query_id, count(*) AS n_exact, count(n.id) AS n_found, round(count(n.id) / count(*), 6) AS recall
        FROM ranked r LEFT JOIN near n USING (query_id, id) GROUP BY r.query_id""",
    "f8_text_search": f"""{_TEXT_SEARCH}, {_ranked(_TEXT_PAIRS, 5)}
        SELECT r.query_id, q.text AS query, r.rank, r.id AS doc_id, r.article_title AS title, p.text,
          r.s AS score
        FROM ranked r JOIN requests q USING (query_id) JOIN paragraphs p ON p.paragraph_id = r.id""",
    "f8_rejected": f"""WITH {_PIECES} SELECT page_id || '_' || position AS query_id,
        'Query cannot be empty' AS error FROM marked WHERE blank""",
    "f8_conversations": f"""WITH {_PARAGRAPHS}, requests AS (
          SELECT conv_id || '_' || turn AS query_id, text FROM conversations WHERE role = 'user'),
        {_embed('stored', 'paragraphs', 'paragraph_id')}, {_embed('asked', 'requests', 'query_id')},
        {_ranked(_TEXT_PAIRS, 5)}
        SELECT query_id, string_agg(id, ',' ORDER BY rank) AS doc_ids FROM ranked GROUP BY query_id""",
    "f8_repeated_ids": f"""WITH {_PARAGRAPHS}, requests AS (
          SELECT conv_id || '_' || turn AS query_id, text, conv_id, role FROM conversations),
        {_embed('stored', 'paragraphs', 'paragraph_id')}, {_embed('asked', 'requests', 'query_id')},
        {_ranked(_TEXT_PAIRS, 50)}
        SELECT CAST(CASE WHEN role = 'user' THEN conv_id END AS VARCHAR) AS query_id, r.text,
          CASE WHEN conv_id % 60 BETWEEN 1 AND 50 THEN (
            SELECT string_agg(id, ',' ORDER BY rank) FROM ranked k WHERE k.query_id = r.query_id AND rank <= conv_id % 60)
          ELSE 'k must be between 1 and 50' END AS outcome
        FROM requests r""",
    "f9_similar": f"""{_DOC_SEARCH} SELECT query_id, 'similar to ' || query_id AS query, rank, id AS doc_id,
        title, text, {_SCORE} FROM ranked""",
    "f9_unknown": """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id, 'id ''' || o_custkey || ''' not found' AS error
        FROM orders WHERE o_custkey NOT IN (SELECT doc_id FROM documents)
        UNION ALL SELECT NULL, 'id ''null'' not found'
        WHERE EXISTS (SELECT 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))""",
    "f10_embed": f"""WITH turns AS (SELECT conv_id || '_' || turn AS id, text FROM conversations),
        {_embed('stored', 'turns', 'id')}
        SELECT t.id, t.text, {_micro('s.vector')} AS vector, 64 AS dims FROM turns t JOIN stored s USING (id)""",
    "g1_unite_shards": _V + "SELECT paragraph_id, article_id, article_title, shard_id FROM vectors",
    "g2_spread": "SELECT doc_id, lang, true AS enough_parts FROM documents",
    "g3_bounded_batches": f"""WITH texts AS (SELECT doc_id, text FROM documents), {_embed('stored', 'texts', 'doc_id')}
        SELECT doc_id, {_micro('vector')} AS vector FROM stored""",
    "i1_embed_paragraphs": _EMBEDDED_PARAGRAPHS,
    "i2_other_dimension": f"""WITH {_REQUESTS}, {_embed('asked', 'requests', 'query_id', 8)}
        SELECT query_id, {_micro('vector')} AS vector FROM asked""",
    "i3_embedder_by_name": _P + """SELECT article_id, count(*) AS n, 16 AS dims FROM paragraphs GROUP BY article_id""",
    "i4_hash_slots": f"""WITH {_PARAGRAPHS}, {_embed('stored', 'paragraphs', 'paragraph_id')}
        SELECT s.paragraph_id, CAST(s.slot AS INTEGER) AS slot,
          round(CAST(CASE WHEN l.length > 0 THEN s.w / l.length ELSE 0 END AS FLOAT)::DOUBLE, 6) AS weight
        FROM stored_slots s JOIN stored_lengths l USING (paragraph_id)""",
    "i5_store_search": f"""{_TEXT_SEARCH}, {_ranked(_TEXT_PAIRS.replace('p.article_title', 'p.article_title, p.article_id'), 5)}
        SELECT {_HITS} FROM ranked""",
    "j1_add_batch": f"WITH {_VECTORS}, {_CHANGED} SELECT * FROM merged",
    "j1_stream_into_batches": f"""WITH {_VECTORS}, {_CHANGED}, {_PARAGRAPHS},
        names AS (SELECT unnest(['one ', 'two ']) AS name)
        SELECT paragraph_id, article_id, article_title, shard_id FROM merged UNION ALL
        SELECT name || paragraph_id, article_id, article_title, CAST(article_id % 4 AS INTEGER)
        FROM paragraphs CROSS JOIN names""",
    "j1_two_streams": f"""WITH {_VECTORS}, {_PARAGRAPHS}, names AS (SELECT unnest(['one ', 'two ']) AS name)
        SELECT paragraph_id, article_id, article_title, shard_id FROM vectors UNION ALL
        SELECT name || paragraph_id, article_id, article_title, CAST(article_id % 4 AS INTEGER)
        FROM paragraphs CROSS JOIN names""",
    "j1_many_batches": f"""WITH {_VECTORS} SELECT paragraph_id, article_id, shard_id,
        CASE WHEN article_id % 19 > 0 THEN 'batch ' || (article_id % 19) ELSE article_title END AS article_title
        FROM vectors""",
    "j1_earlier_version": f"""WITH {_VECTORS}, {_CHANGED}
        SELECT paragraph_id, article_id, article_title, shard_id, 0 AS version FROM vectors UNION ALL
        SELECT paragraph_id, article_id, article_title, shard_id, 1 FROM merged""",
    "f7_fitted_share": f"""WITH {_VECTORS}, {_EVERY}, {_ranked(_SAMPLE_PAIRS, 3)}
        SELECT query_id, rank, id, {_SCORE}, share FROM ranked
        CROSS JOIN (SELECT unnest([1.0::DOUBLE, 0.5::DOUBLE]) AS share) s""",
    "j1_compact": f"WITH {_VECTORS}, {_CHANGED} SELECT * FROM merged",
    "j1_stream_add": f"""WITH {_VECTORS}, {_PARAGRAPHS}, arrived AS (
          SELECT paragraph_id, article_id, article_title, CAST(article_id % 4 AS INTEGER) AS shard_id FROM paragraphs)
        SELECT * FROM arrived UNION ALL
        SELECT paragraph_id, article_id, article_title, shard_id FROM vectors
        WHERE paragraph_id NOT IN (SELECT paragraph_id FROM arrived)""",
}
ORACLE["f2_bounded_topk"] = f"{_EVERY10} SELECT query_id, rank, id, {_SCORE} FROM ranked"
ORACLE["b1_replace_shards"] = f"""WITH {_VECTORS} SELECT paragraph_id, article_id, shard_id,
    CASE WHEN shard_id IN (1, 2) THEN 'again' ELSE article_title END AS article_title
    FROM vectors WHERE shard_id NOT IN (1, 2) OR article_id % 3 > 0"""
_SHARES = [
    f"""SELECT {p} AS probes, (SELECT count(DISTINCT id) FROM candidates) AS n_candidates,
        (SELECT count(*) FROM vectors) AS n_rows,
        round((SELECT count(*) FROM (SELECT query_id, id FROM ranked WHERE rank <= 10) JOIN best USING (query_id, id))
              / (SELECT count(*) FROM best), 6) AS recall"""
    for p in (1, 4, 16)
]
_BEST = f"""best AS (SELECT query_id, id FROM (
    SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 9) DESC, id) AS place
    FROM ({_SAMPLE_PAIRS})) WHERE place <= 10)"""
ORACLE["f6_postings_share"] = " UNION ALL ".join(
    f"(WITH {_VECTORS}, {_SAMPLES}, {_probed(p)}, {_BEST}, {_ranked(_LSH_SAMPLE_PAIRS, 10)} {share})"
    for p, share in zip((1, 4, 16), _SHARES, strict=True)
)
ORACLE["f6_postings_topk"] = f"""WITH {_VECTORS}, {_EVERY}, {_probed(3)}, {_ranked(_LSH_SAMPLE_PAIRS, 10)}
    SELECT query_id, rank, id, {_SCORE} FROM ranked"""
ORACLE["f5_routes"] = f"""{_EVERY10} SELECT query_id, rank, id, {_SCORE}, n.num_shards
    FROM ranked CROSS JOIN (SELECT unnest([1, 4, 7]) AS num_shards) n"""
