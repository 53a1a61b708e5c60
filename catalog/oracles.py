"""DuckDB SQL with the results the catalogued queries must have."""

from __future__ import annotations

from shelfmark import fixed

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


# Shared parts

PLACED = """
placed AS (
    SELECT vec_id, embedding, label, CAST(1 + vec_id % 6 AS INTEGER) AS level,
           CAST(vec_id * 7 // 10 AS VARCHAR) AS number,
           [p_type, p_brand, 'size ' || p_size, p_name, 'attr ' || (vec_id % 7), 'value ' || (vec_id % 13)] AS titles
    FROM embeddings JOIN part ON p_partkey = vec_id % (SELECT count(*) FROM part)
)"""

CORPUS = PLACED + """,
corpus AS (
    SELECT vec_id AS position, embedding, label, level, number,
           CASE label WHEN 9 THEN 'n' || number WHEN 8 THEN lpad(number, 8, '0') ELSE number END AS id,
           CASE WHEN label = 0 AND level = 1 THEN [''] ELSE titles[1:level] END AS path
    FROM placed
),
keyed_corpus AS (SELECT *, CASE WHEN label = 9 THEN id ELSE number END AS key FROM corpus),
lookup AS (
    SELECT key, arg_max(level, position) AS level, arg_max(id, position) AS code, arg_max(path, position) AS path
    FROM keyed_corpus GROUP BY key
)"""

BY_CODE = CORPUS + """,
resolved AS (
    SELECT c.position, c.id,
           CASE WHEN label = 9 THEN c.level ELSE l.level END AS level,
           CASE WHEN label = 9 THEN c.id ELSE l.code END AS code,
           CASE WHEN label = 9 THEN c.path ELSE l.path END AS path
    FROM keyed_corpus c LEFT JOIN lookup l USING (key)
)"""

BY_POSITION = CORPUS + """,
resolved AS (SELECT position, id, level, id AS code, path FROM corpus)"""

UNIT = """
unit AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / norm) AS v
    FROM (SELECT vec_id, embedding,
                 sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm
          FROM embeddings)
)"""

NEAREST = UNIT + """,
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS position, list_distance(q.v, c.v) ** 2 AS score
    FROM unit q, unit c
),
nearest AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, position) AS rank FROM scored
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, position) <= 30
)"""

HITS = """
hits AS (
    SELECT query_id, CAST(rank AS INTEGER) AS rank, position, score, id, level, code, path,
           path[len(path)] AS title, array_to_string(path, ' > ') AS hierarchy_string
    FROM nearest JOIN resolved USING (position)
)"""

CANDIDATES = """
keyed AS (
    SELECT *, path[1:4] AS prefix, array_to_string(path[1:4], ' > ') AS key FROM hits
    WHERE array_to_string(path[1:4], ' > ') <> ''
),
grouped AS (
    SELECT query_id, key, min(score) AS score, min(rank) AS first_rank, arg_min(prefix, rank) AS prefix
    FROM keyed GROUP BY query_id, key
),
options AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, first_rank) AS INTEGER) AS rank
    FROM grouped
),
lettered AS (
    SELECT *, CASE WHEN rank <= 26 THEN chr(64 + rank) ELSE 'Z' || (rank - 1) END AS letter FROM options
),
attributes AS (
    SELECT query_id, key, level, code, title, rank AS hit_rank FROM keyed WHERE level >= 5
    QUALIFY row_number() OVER (PARTITION BY query_id, key, code ORDER BY rank) = 1
),
titles_at AS (
    SELECT query_id, key, arg_min(title, hit_rank) FILTER (level = 5) AS title5,
           arg_min(title, hit_rank) FILTER (level = 6) AS title6,
           string_agg(title, ', ' ORDER BY hit_rank) AS listed
    FROM attributes GROUP BY query_id, key
),
full_options AS (
    SELECT o.*, t.title5, t.title6, t.listed
    FROM lettered o LEFT JOIN titles_at t ON o.query_id = t.query_id AND o.key = t.key
)"""

SIX_COLUMNS = """
    coalesce(prefix[1], '') AS gs1_segment, coalesce(prefix[2], '') AS gs1_family,
    coalesce(prefix[3], '') AS gs1_class, coalesce(prefix[4], '') AS gs1_brick,
    coalesce(title5, '') AS gs1_attribute, coalesce(title6, '') AS gs1_attribute_value"""

LABELLED = """
labelled AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

PRODUCTS = """
products AS (
    SELECT vec_id AS product_id, p_name, p_brand, p_size, p_retailprice, embedding,
           CASE WHEN label = 4 THEN 'skipped' WHEN p_size = 50 THEN 'failed' ELSE 'ok' END AS vector_status,
           CASE WHEN label < 3 THEN p_type END AS gs1_segment,
           CASE WHEN label < 3 THEN p_brand END AS gs1_family
    FROM embeddings JOIN part ON p_partkey = vec_id % (SELECT count(*) FROM part)
)"""

PREPARED = PRODUCTS + """,
numbered AS (
    SELECT *, (row_number() OVER (ORDER BY product_id) - 1) // 10 + 1 AS batch
    FROM products WHERE gs1_segment IS NULL
),
asked AS (
    SELECT * FROM numbered
    WHERE vector_status = 'ok' AND batch NOT IN (SELECT batch FROM numbered WHERE vector_status = 'failed')
)"""

PROMPT_TEXTS = """
option_texts AS (
    SELECT query_id, string_agg('[' || letter || '] ' || key || coalesce(' | ' || listed, '') || chr(10), '' ORDER BY rank) AS listed,
           string_agg('[' || letter || '] ' || key || chr(10), '' ORDER BY rank) AS plain
    FROM full_options GROUP BY query_id
),
blocks AS (
    SELECT batch, product_id,
           chr(10) || '--- Product ' || product_id || ' ---' || chr(10)
           || 'p_name: ' || p_name || chr(10) || 'p_brand: ' || p_brand || chr(10)
           || 'p_size: ' || p_size || chr(10) || 'p_retailprice: ' || p_retailprice || chr(10)
           || chr(10) || 'Candidate categories:' || chr(10) || coalesce(listed, '') || chr(10) AS block,
           '--- Product ' || product_id || ' ---' || chr(10)
           || '{"p_brand": "' || p_brand || '", "p_name": "' || p_name || '", "p_retailprice": "' || p_retailprice
           || '", "p_size": "' || p_size || '"}' || chr(10) || chr(10)
           || 'Candidates:' || chr(10) || coalesce(plain, '') || chr(10) AS plain_block
    FROM asked LEFT JOIN option_texts ON product_id = query_id
),
messages AS (
    SELECT batch, CAST(count(*) AS INTEGER) AS products,
           'Classify the following ' || count(*) || ' product(s) into GS1 GPC categories.' || chr(10) || chr(10)
           || string_agg(block, '' ORDER BY product_id)
           || {tail} AS user_message,
           {plain_head} || string_agg(plain_block, '' ORDER BY product_id) || {plain_tail} AS plain_message,
           '{{"results": [' || string_agg('{{"product_id": ' || product_id || ', "choice": "A"}}', ', ' ORDER BY product_id)
           || ']}}' AS content
    FROM blocks GROUP BY batch
)"""
PROMPT_TEXTS = (
    PROMPT_TEXTS.replace("{tail}", _text(fixed.USER_PROMPT_TAIL))
    .replace("{plain_head}", _text(fixed.PLAIN_PROMPT_HEAD))
    .replace("{plain_tail}", _text(fixed.PLAIN_PROMPT_TAIL))
    .replace("{{", "{").replace("}}", "}")
)

USAGE = f"""
used AS (
    SELECT batch, content,
           CAST(({len(fixed.SYSTEM_PROMPT)} + length(user_message)) // 4 AS INTEGER) AS prompt_tokens,
           CAST(length(content) // 4 AS INTEGER) AS completion_tokens
    FROM messages
)"""

RESPONSES = """
answered AS (
    SELECT vec_id, vec_id // 10 + 1 AS batch, (vec_id // 10 + 1) % 12 AS shape, vec_id % 10 AS place,
           CASE WHEN label = 9 THEN 'Z27' ELSE chr(65 + 3 * label) END AS letter
    FROM embeddings
),
good_answers AS (
    SELECT batch, shape, place AS ordinal, CAST(vec_id AS VARCHAR) AS id_text,
           CASE WHEN shape = 11 THEN '' ELSE letter END AS choice, vec_id AS product_id
    FROM answered WHERE shape IN (0, 1, 2, 7, 8, 11)
    UNION ALL
    SELECT batch, shape, count(*), CAST(min(vec_id) AS VARCHAR), 'A', min(vec_id)
    FROM answered WHERE shape = 8 GROUP BY batch, shape
),
response_errors AS (
    SELECT DISTINCT batch,
           CASE WHEN shape = 6 THEN 'the choice of an answer is not text' ELSE {unparseable} END AS error
    FROM answered WHERE shape IN (5, 6, 9, 10)
),
matched AS (
    SELECT a.batch, a.ordinal, a.product_id, a.id_text, a.choice, o.key, o.prefix, o.title5, o.title6
    FROM good_answers a
    LEFT JOIN full_options o ON o.query_id = a.product_id AND a.shape <> 7 AND upper(o.letter) = a.choice
)""".replace("{unparseable}", _text(fixed.UNPARSEABLE))

HASHED = """
tokens AS (
    SELECT key, token FROM (SELECT key, unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS token FROM texts)
    WHERE token <> ''
),
cells AS (
    SELECT key, CAST('0x' || substr(md5(token), 1, 4) AS INTEGER) % 64 AS component,
           sum(CASE WHEN CAST('0x' || substr(md5(token), 5, 1) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END) AS weight
    FROM tokens GROUP BY 1, 2
),
vectors AS (
    SELECT key, '[' || string_agg(coalesce(CAST(weight AS BIGINT), 0) || '.0', ',' ORDER BY component) || ']' AS vector
    FROM (SELECT key, CAST(range AS INTEGER) AS component FROM texts, range(64)) LEFT JOIN cells USING (key, component)
    GROUP BY key
)"""

TREE = """
base AS (
    SELECT c_custkey AS document, c_mktsegment <> 'MACHINERY' AS listed, c_custkey, c_name, c_acctbal, c_mktsegment,
           n_nationkey, n_name, r_regionkey, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
nodes AS (
    SELECT document, [0] AS place, CAST(r_regionkey AS VARCHAR) AS id, 1 AS level, [r_name] AS path,
           '' AS definition, '' AS excludes, true AS active FROM base
    UNION ALL
    SELECT document, [0, 0], CAST(n_nationkey AS VARCHAR), 2, [r_name, n_name], 'Nation of ' || r_name, '', true FROM base
    UNION ALL
    SELECT document, [0, 0, 0], c_mktsegment, 3, [r_name, n_name, c_mktsegment], '', 'other segments', true FROM base
    UNION ALL
    SELECT document, [0, 0, 0, 0], CAST(c_custkey AS VARCHAR), 4, [r_name, n_name, c_mktsegment, c_name],
           '', '', c_acctbal >= 0 FROM base
    UNION ALL
    SELECT document, [1], 'balance', 0, ['Balance'], '', '', true FROM base WHERE listed
    UNION ALL
    SELECT document, [1, 0], '', 2, ['Balance', 'Amount'], CAST(c_acctbal AS VARCHAR), '', true FROM base WHERE listed
),
flat AS (
    SELECT row_number() OVER (ORDER BY document, place) - 1 AS position, document, id, level, path[len(path)] AS title,
           array_to_string(path, ' > ') AS hierarchy_string, CAST(len(path) AS INTEGER) AS depth,
           definition, excludes, active,
           array_to_string(path, ' > ') || CASE WHEN definition <> '' THEN ' | ' || definition ELSE '' END
           || CASE WHEN excludes <> '' THEN ' | Excludes: ' || excludes ELSE '' END AS text
    FROM nodes
)"""

# Vectors and search

ORACLES["l2_normalize"] = _with(UNIT) + """
SELECT vec_id, CAST(component AS INTEGER) AS component, round(v[component + 1], 6) + 0.0 AS value
FROM unit, range(64) r(component)"""

ORACLES["squared_distance"] = _with(UNIT) + """
SELECT a.vec_id, round(list_distance(a.v, b.v) ** 2, 6) + 0.0 AS score FROM unit a JOIN unit b ON b.vec_id = a.vec_id + 1"""

ORACLES["knn_single"] = _with(CORPUS, UNIT) + """
SELECT c.vec_id AS position, k.id, round(list_distance(q.v, c.v) ** 2, 6) + 0.0 AS score
FROM unit c JOIN corpus k ON k.position = c.vec_id, (SELECT v FROM unit ORDER BY vec_id LIMIT 1) q
ORDER BY list_distance(q.v, c.v), c.vec_id LIMIT 30"""

_RANKED = "SELECT query_id, rank, position, id, round(score, 6) + 0.0 AS score FROM hits"
ORACLES["knn_batch"] = _with(BY_CODE, NEAREST, HITS) + _RANKED
ORACLES["knn_blocks"] = ORACLES["knn_batch"]

_METADATA = "SELECT query_id, rank, id, level, code, title, hierarchy_string FROM hits"
ORACLES["knn_metadata_code"] = _with(BY_CODE, NEAREST, HITS) + _METADATA
ORACLES["knn_metadata_position"] = _with(BY_POSITION, NEAREST, HITS) + _METADATA

# Candidates

_OPTIONS = _with(BY_CODE, NEAREST, HITS, CANDIDATES)
ORACLES["candidate_groups"] = _OPTIONS + """
SELECT query_id, key AS hierarchy_string, round(score, 6) + 0.0 AS score, CAST(len(prefix) AS INTEGER) AS depth
FROM options"""
ORACLES["candidate_attributes"] = _OPTIONS + """
SELECT query_id, key AS hierarchy_string,
       CAST(row_number() OVER (PARTITION BY query_id, key ORDER BY hit_rank) - 1 AS INTEGER) AS place,
       level, code, title
FROM attributes"""
ORACLES["candidate_letters"] = _OPTIONS + """
SELECT query_id, rank, letter, key AS hierarchy_string, round(score, 6) + 0.0 AS score FROM lettered"""
ORACLES["candidate_lists"] = _with(BY_CODE, NEAREST, HITS, CANDIDATES, PRODUCTS) + """
SELECT product_id, CAST(count(key) AS INTEGER) AS options,
       coalesce(string_agg(letter, ' ' ORDER BY rank), '') AS letters,
       coalesce(string_agg(key, '; ' ORDER BY rank), '') AS paths
FROM products LEFT JOIN lettered ON query_id = product_id AND vector_status = 'ok'
GROUP BY product_id"""
ORACLES["level_columns"] = _OPTIONS + f"SELECT query_id, rank - 1 AS place, {SIX_COLUMNS} FROM full_options"

# Taxonomy corpus

ORACLES["tree_flatten"] = _with(TREE) + """
SELECT position, document, id, level,
       CASE level WHEN 1 THEN 'Segment' WHEN 2 THEN 'Family' WHEN 3 THEN 'Class' WHEN 4 THEN 'Brick' END AS level_name,
       title, hierarchy_string, depth, definition, excludes, active, text
FROM flat"""
ORACLES["node_text"] = """
SELECT p_partkey, p_type || ' > ' || p_brand || CASE WHEN p_size > 25 THEN ' | ' || p_name ELSE '' END
       || CASE WHEN p_size % 3 = 0 THEN ' | Excludes: size ' || p_size ELSE '' END AS text
FROM part"""
ORACLES["lookup_build"] = _with(CORPUS) + """
SELECT key, level, code, path[len(path)] AS title, array_to_string(path, ' > ') AS hierarchy_string,
       CAST(NULL AS VARCHAR) AS unit
FROM lookup"""
ORACLES["manifest"] = """
SELECT 'hash-64' AS model, CAST(max(len(embedding)) AS INTEGER) AS dimensions, count(*) AS document_count,
       'FlatL2' AS index_type, 'gs1' AS prefix
FROM embeddings JOIN part ON p_partkey = vec_id % (SELECT count(*) FROM part)"""
ORACLES["corpus_roundtrip"] = _with(CORPUS) + """
SELECT 'corpus' AS part, id, array_to_string(path, ' > ') || ' | ' || number AS text, CAST(position AS DOUBLE) + 0.0 AS number
FROM corpus
UNION ALL
SELECT 'archive', id, array_to_string(path, ' > ') || ' | ' || number,
       round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) + 0.0 FROM corpus
UNION ALL
SELECT 'metadata', id, array_to_string(path, ' > '), CAST(level AS DOUBLE) + 0.0 FROM corpus
UNION ALL
SELECT 'lookup', key, path[len(path)], CAST(level AS DOUBLE) + 0.0 FROM lookup"""
ORACLES["vector_check"] = _with(PRODUCTS) + """
SELECT count(*) AS rows, count(*) FILTER (vector_status <> 'ok') AS missing, CAST(0 AS BIGINT) AS wrong_size
FROM products"""

# Rows

ORACLES["pending_embed"] = """
SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
ORACLES["pending_classify"] = _with(PRODUCTS) + """
SELECT product_id, p_name, p_brand, p_size, p_retailprice FROM products WHERE gs1_segment IS NULL"""
ORACLES["pending_count"] = """
SELECT count(*) AS remaining FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""
ORACLES["page_rows"] = "SELECT * FROM customer ORDER BY c_custkey LIMIT 25 OFFSET 40"
ORACLES["param_sql"] = "SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 10 AND p_type <> 'ECONOMY'"
ORACLES["row_text"] = """
SELECT p_partkey, p_name || ' * ' || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END || ' * ' || p_brand || ' * '
       || CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size % 5 AS VARCHAR) END || ' * ' || p_retailprice AS text
FROM part"""
ORACLES["row_embedding"] = _with(
    LABELLED, "texts AS (SELECT doc_id AS key, text FROM labelled WHERE quality IS NULL)", HASHED
) + "SELECT key AS doc_id, vector FROM vectors"
ORACLES["vector_parse"] = _with(PRODUCTS) + """
SELECT product_id, vector_status,
       CASE WHEN vector_status = 'ok' THEN round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) + 0.0 END AS total
FROM products"""
ORACLES["prompt_context"] = """
SELECT p_partkey, 0 AS place, 'p_name' AS key, p_name AS value FROM part
UNION ALL SELECT p_partkey, 1, 'p_brand', p_brand FROM part
UNION ALL SELECT p_partkey, 2, 'p_size', CASE WHEN p_size = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END FROM part
UNION ALL SELECT p_partkey, 3, 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part"""

# Prompts and model calls

ORACLES["prompt_batches"] = _with(LABELLED) + """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 10 + 1 AS batch FROM labelled WHERE quality IS NULL"""

_PROMPTS = _with(BY_CODE, NEAREST, HITS, CANDIDATES, PREPARED, PROMPT_TEXTS)
ORACLES["prompt_text"] = _PROMPTS + f"""
SELECT batch, products, md5({_text(fixed.SYSTEM_PROMPT)}) AS system_md5, user_message FROM messages"""
ORACLES["prompt_fallback"] = _PROMPTS + f"""
SELECT batch, products, md5({_text(fixed.PLAIN_SYSTEM_PROMPT)}) AS system_md5, plain_message AS user_message FROM messages"""

_CHAT = _with(BY_CODE, NEAREST, HITS, CANDIDATES, PREPARED, PROMPT_TEXTS, USAGE)
ORACLES["chat_offline"] = _CHAT + """
SELECT batch, content, prompt_tokens, completion_tokens, prompt_tokens + completion_tokens AS total_tokens FROM used"""
ORACLES["token_usage"] = _CHAT + """
SELECT count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
       CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
       CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens
FROM used"""

# Responses

_RESPONSES = _with(BY_CODE, NEAREST, HITS, CANDIDATES, RESPONSES)
ORACLES["response_json"] = _RESPONSES + """
SELECT b.batch, CASE WHEN e.error IS NULL THEN CAST(coalesce(g.n, 0) AS INTEGER) END AS answers, e.error
FROM (SELECT DISTINCT batch FROM answered) b
LEFT JOIN response_errors e USING (batch)
LEFT JOIN (SELECT batch, count(*) AS n FROM good_answers GROUP BY batch) g USING (batch)"""
ORACLES["response_regex"] = _RESPONSES + f"""
SELECT b.batch,
       CASE WHEN b.shape NOT IN (3, 5, 6, 9, 10) THEN CAST(coalesce(g.n, 0) AS INTEGER) END AS answers,
       CASE WHEN b.shape = 6 THEN 'the choice of an answer is not text'
            WHEN b.shape IN (3, 5, 9, 10) THEN {_text(fixed.UNPARSEABLE)} END AS error
FROM (SELECT DISTINCT batch, shape FROM answered) b
LEFT JOIN (SELECT batch, count(*) AS n FROM good_answers GROUP BY batch) g USING (batch)"""
ORACLES["response_failures"] = _RESPONSES + """
SELECT vec_id AS product_id, batch, error FROM answered JOIN response_errors USING (batch)"""
ORACLES["answers"] = _RESPONSES + """
SELECT batch, CAST(ordinal AS INTEGER) AS ordinal, id_text, choice FROM good_answers"""
ORACLES["choice_join"] = _RESPONSES + """
SELECT batch, CAST(ordinal AS INTEGER) AS ordinal, product_id, choice, key AS path FROM matched WHERE key IS NOT NULL"""
ORACLES["choice_unmatched"] = _RESPONSES + """
SELECT batch, CAST(ordinal AS INTEGER) AS ordinal, id_text, choice FROM matched WHERE key IS NULL"""
ORACLES["result_dedupe"] = _RESPONSES + f"""
SELECT product_id, CAST(ordinal AS INTEGER) AS ordinal, {SIX_COLUMNS} FROM matched WHERE key IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ordinal DESC) = 1"""

# Write-back and reports

ORACLES["keyed_update"] = """
SELECT c_custkey, c_name, c_nationkey, coalesce(o_totalprice, c_acctbal) AS c_acctbal,
       coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment
FROM customer LEFT JOIN (
    SELECT o_custkey, o_orderpriority, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
) ON o_custkey = c_custkey"""
ORACLES["taxonomy_scan"] = (
    "SELECT id, level, title, hierarchy_string, definition, excludes, active, text FROM (" + ORACLES["tree_flatten"] + ")")
ORACLES["keyed_in_place"] = ORACLES["keyed_update"]
ORACLES["category_counts"] = """
WITH results AS (
    SELECT event_id // 20 AS batch, event_id AS ordinal,
           CASE WHEN event_type = 'view' THEN 'H&B Care'
                WHEN event_type = 'click' THEN 'Non-Alc. Bev. - Prep.'
                WHEN value < 1 THEN '' ELSE event_type END AS label
    FROM events
), counts AS (
    SELECT batch, label AS category, count(*) AS classified, min(ordinal) AS first
    FROM results WHERE label <> '' GROUP BY batch, label
)
SELECT batch, CAST(row_number() OVER w AS INTEGER) AS rank, category, classified,
       greatest(count(*) OVER (PARTITION BY batch) - 4, 0) AS others
FROM counts WINDOW w AS (PARTITION BY batch ORDER BY classified DESC, first)
QUALIFY row_number() OVER w <= 4"""
ORACLES["run_summary"] = _RESPONSES + """
SELECT (SELECT count(*) FROM matched WHERE key IS NOT NULL) AS classified,
       (SELECT count(*) FROM answered JOIN response_errors USING (batch)) AS failed,
       (SELECT count(*) FROM matched WHERE key IS NOT NULL)
       + (SELECT count(*) FROM answered JOIN response_errors USING (batch)) AS total,
       (SELECT (count(*) + 9) // 10 FROM embeddings) AS batches"""
ORACLES["verify_listing"] = _with(PRODUCTS) + """
SELECT product_id, gs1_segment, gs1_family FROM products WHERE gs1_segment IS NOT NULL ORDER BY product_id LIMIT 10"""

# Jobs

ORACLES["job_build"] = _with(TREE, "texts AS (SELECT position AS key, text FROM flat)", HASHED) + """
SELECT position, id, flat.text, level, vector FROM flat JOIN vectors ON key = position"""
ORACLES["job_embed"] = _with(
    LABELLED, "texts AS (SELECT doc_id AS key, lang || ' * ' || text AS text FROM labelled WHERE quality IS NULL)", HASHED
) + """
SELECT doc_id, coalesce('[' || quality || ']', vector) AS embedding_context
FROM labelled LEFT JOIN vectors ON key = doc_id"""

ORACLES["job_embed_in_place"] = ORACLES["job_embed"]

_JOB = _with(BY_CODE, NEAREST, HITS, CANDIDATES, PREPARED) + f"""
, chosen AS (
    SELECT product_id, {SIX_COLUMNS} FROM asked JOIN full_options ON query_id = product_id AND rank = 1
),
failed AS (
    SELECT product_id, batch, 'malformed vector' AS error FROM numbered
    WHERE batch IN (SELECT batch FROM numbered WHERE vector_status = 'failed')
)
"""
ORACLES["job_classify"] = _JOB + """
SELECT p.product_id, coalesce(c.gs1_segment, p.gs1_segment) AS gs1_segment,
       coalesce(c.gs1_family, p.gs1_family) AS gs1_family, c.gs1_class, c.gs1_brick, c.gs1_attribute, c.gs1_attribute_value
FROM products p LEFT JOIN chosen c ON c.product_id = p.product_id"""
ORACLES["job_summary"] = _JOB + """
SELECT c.n AS classified, f.n AS failed, c.n + f.n AS total, (p.n + 9) // 10 AS batches
FROM (SELECT count(*) AS n FROM chosen) c, (SELECT count(*) AS n FROM failed) f, (SELECT count(*) AS n FROM numbered) p"""
ORACLES["job_unresolved"] = _JOB + """
SELECT product_id, batch, vector_status FROM numbered
WHERE product_id NOT IN (SELECT product_id FROM chosen) AND product_id NOT IN (SELECT product_id FROM failed)"""
ORACLES["failure_log"] = _JOB + "SELECT product_id, batch, error FROM failed"
