"""Inputs that the catalogued queries derive from the given tables with Spark."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.answers import answer_rows, match_answers, parse_responses
from shelfmark.operators.candidates import with_candidates
from shelfmark.operators.knn import nearest
from shelfmark.operators.metadata import resolve_metadata
from shelfmark.sources.corpus import lookup_rows
from shelfmark.sources.taxonomy import top_nodes

DIMENSION = 64
PROMPT_COLUMNS = ["p_name", "p_brand", "p_size", "p_retailprice"]
TARGETS = ["gs1_segment", "gs1_family", "gs1_class", "gs1_brick", "gs1_attribute", "gs1_attribute_value"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sql(spark: SparkSession, folder: str, query: str, *names: str) -> DataFrame:
    return spark.sql(query, **{name: table(spark, folder, name) for name in names})


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as a document whose path comes from a part.

    Codes repeat (ten documents share seven codes), some are padded with zeros
    and some are no numbers; a few paths are empty.
    """
    return _sql(spark, folder, """
        WITH placed AS (
            SELECT vec_id, embedding, label,
                   CAST(1 + vec_id % 6 AS INT) AS level,
                   CAST(vec_id * 7 DIV 10 AS STRING) AS number,
                   array(p_type, p_brand, 'size ' || p_size, p_name,
                         'attr ' || (vec_id % 7), 'value ' || (vec_id % 13)) AS titles
            FROM {embeddings} JOIN {part} ON p_partkey = vec_id % (SELECT count(*) FROM {part})
        ), pathed AS (
            SELECT *,
                   CASE label WHEN 9 THEN 'n' || number WHEN 8 THEN lpad(number, 8, '0') ELSE number END AS id,
                   CASE WHEN label = 0 AND level = 1 THEN array('') ELSE slice(titles, 1, level) END AS path
            FROM placed
        )
        SELECT vec_id AS position, id, array_join(path, ' > ') || ' | ' || number AS text,
               level, id AS code, element_at(path, -1) AS title, path AS hierarchy_path,
               array_join(path, ' > ') AS hierarchy_string, number AS definition, '' AS excludes,
               label <> 5 AS active, 'gs1_gpc' AS source, embedding
        FROM pathed
    """, "embeddings", "part")


def resolved_corpus(spark: SparkSession, folder: str, key: str = "code") -> DataFrame:
    documents = corpus(spark, folder)
    return resolve_metadata(documents, lookup_rows(documents) if key == "code" else None, key)


def query_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def hits(spark: SparkSession, folder: str, key: str = "code") -> DataFrame:
    return nearest(query_vectors(spark, folder), resolved_corpus(spark, folder, key))


def hit_rows(found: DataFrame) -> DataFrame:
    exploded = found.select("query_id", F.posexplode("hits").alias("place", "hit"))
    return exploded.select("query_id", (F.col("place") + 1).alias("rank"), "hit.*")


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    return with_candidates(hits(spark, folder))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as a product row: some have no vector, some a broken one,
    and those of labels 0 to 2 have classes already."""
    return _sql(spark, folder, """
        SELECT vec_id AS product_id, p_name, p_brand, p_size, p_retailprice,
               CASE WHEN label = 4 THEN NULL WHEN p_size = 50 THEN '[0.1, oops' ELSE to_json(embedding) END
                   AS embedding_context,
               CASE WHEN label < 3 THEN p_type END AS gs1_segment,
               CASE WHEN label < 3 THEN p_brand END AS gs1_family,
               CAST(NULL AS STRING) AS gs1_class, CAST(NULL AS STRING) AS gs1_brick,
               CAST(NULL AS STRING) AS gs1_attribute, CAST(NULL AS STRING) AS gs1_attribute_value
        FROM {embeddings} JOIN {part} ON p_partkey = vec_id % (SELECT count(*) FROM {part})
    """, "embeddings", "part")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their label; ``quality`` is NULL for those without."""
    return _sql(spark, folder, """
        SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
    """, "documents", "labels")


def tree_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One small taxonomy document per customer.

    region > nation > market segment > customer, and a second tree with the
    balance; documents of one segment hold a single node instead of a list.
    """
    return _sql(spark, folder, """
        WITH parts AS (
            SELECT c_custkey, c_mktsegment,
                to_json(named_struct('Code', r_regionkey, 'Title', '  ' || r_name || ' ', 'Level', 1, 'Childs', array(
                    named_struct('Code', n_nationkey, 'Title', n_name, 'Level', 2,
                                 'Definition', ' Nation of ' || r_name || ' ', 'Childs', array(
                        named_struct('Code', c_mktsegment, 'Title', c_mktsegment, 'Level', 3,
                                     'DefinitionExcludes', 'other segments', 'Childs', array(
                            named_struct('Code', c_custkey, 'Title', c_name, 'Level', 4, 'Active', c_acctbal >= 0)
                        ))
                    ))
                ))) AS place,
                to_json(named_struct('Code', 'balance', 'Title', 'Balance', 'Childs', array(
                    named_struct('Title', 'Amount', 'Level', 2, 'Definition', CAST(c_acctbal AS STRING))
                ))) AS balance
            FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        )
        SELECT c_custkey AS document,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN concat('{{"Schema": ', place, '}}')
                    ELSE concat('{{"Schema": [', place, ', ', balance, ']}}') END AS content
        FROM parts
    """, "customer", "nation", "region")


def taxonomy_files(spark: SparkSession, folder: str, path: str) -> str:
    """All trees of :func:`tree_documents` as JSON files, a file for each task with many top-level nodes."""

    def listed(batches):
        yield pa.RecordBatch.from_pydict({"value": ['{"Schema": [']})
        first = True
        for batch in batches:
            lines = [line if first and i == 0 else f", {line}" for i, line in enumerate(batch.column(0).to_pylist())]
            first = first and not lines
            yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["]}"]})

    nodes = top_nodes(tree_documents(spark, folder)).select(F.to_json("node").alias("value"))
    nodes.mapInArrow(listed, "value string").write.text(path)
    return path


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """One model response per ten products, in twelve good and bad shapes."""
    return _sql(spark, folder, """
        WITH answers AS (
            SELECT vec_id, vec_id DIV 10 + 1 AS batch, label,
                   CASE WHEN label = 9 THEN 'Z27' ELSE char(65 + 3 * label) END AS letter
            FROM {embeddings}
        ), texts AS (
            SELECT batch, vec_id,
                   '{{"product_id": ' || vec_id || ', "choice": "' ||
                       CASE WHEN label % 2 = 1 THEN ' ' || lower(letter) || ' ' ELSE letter END || '"}}' AS plain,
                   '{{"product_id": "' || vec_id || '", "choice": "' || letter || '"}}' AS texted,
                   '{{"product_id": ' || vec_id || '}}' AS silent
            FROM answers
        ), lists AS (
            SELECT batch, min(vec_id) AS first_id, array_sort(collect_list(struct(vec_id, plain, texted, silent))) AS items
            FROM texts GROUP BY batch
        ), joined AS (
            SELECT batch, first_id, array_join(items.plain, ', ') AS plain, array_join(items.texted, ', ') AS texted,
                   array_join(items.silent, ', ') AS silent
            FROM lists
        )
        SELECT batch,
               CASE batch % 12
                   WHEN 0 THEN '{{"results": [' || plain || ']}}'
                   WHEN 1 THEN '[' || plain || ']'
                   WHEN 2 THEN 'Here is my answer: [' || plain || '] Hope that helps!'
                   WHEN 3 THEN '{{"note": [], "results": [' || plain || ']}}'
                   WHEN 4 THEN '{{"results": []}}'
                   WHEN 5 THEN 'This is not JSON or any list'
                   WHEN 6 THEN '{{"results": [' || plain || ', {{"product_id": 1, "choice": null}}]}}'
                   WHEN 7 THEN '{{"results": [' || texted || ']}}'
                   WHEN 8 THEN '{{"results": [' || plain || ', {{"product_id": ' || first_id || ', "choice": "A"}}]}}'
                   WHEN 9 THEN 'see [1] and [' || plain || ']'
                   WHEN 10 THEN '{{"results": [' || plain || ']}} [done]'
                   ELSE '{{"results": [' || silent || ']}}'
               END AS content
        FROM joined
    """, "embeddings")


def candidate_products(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of every embedding as product, with its batch."""
    return candidates(spark, folder).select(
        F.col("query_id").alias("product_id"), F.expr("query_id DIV 10 + 1").alias("batch"), "candidates"
    )


def matches(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_responses(responses(spark, folder))
    return match_answers(answer_rows(parsed), candidate_products(spark, folder), "product_id")
