"""Taxonomy trees to one row per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx
from shelfmark.operators.numbering import number_rows
from shelfmark.session import materialize

_WALK = """
WITH RECURSIVE walk ({key}, place, path, node) AS (
    SELECT {key}, array(place), array({title}), node
    FROM {{top}}
    UNION ALL
    SELECT {spread} {key}, concat(place, array(child_place)), concat(path, array({child_title})), child
    FROM walk, LATERAL variant_explode(variant_get(node, '$.Childs')) AS c (child_place, child_key, child)
)
SELECT * FROM walk
"""


def _title(node: str) -> str:
    title = f"coalesce(variant_get({node}, '$.Title', 'string'), '')"
    return rf"regexp_replace({title}, r'(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '')"


def walk_tree(top: DataFrame, key: str = "document", spread: int | None = None) -> DataFrame:
    """All nodes below ``top`` at any depth: ``key``, ``place``, ``path``, ``node``.

    ``place`` lists the child numbers from the root, so it sorts in pre-order;
    ``path`` lists the titles. ``spread`` redistributes every level over that
    many partitions: use it where few documents hold many nodes. With its
    default, ``spark.sql.cteRecursionRowLimit`` stops a walk at a million
    nodes; :func:`flatten_tree` lifts that while it writes.
    """
    spark = top.sparkSession
    hint = f"/*+ REPARTITION({spread}) */" if spread else ""
    query = _WALK.format(key=key, title=_title("node"), child_title=_title("child"), spread=hint)
    return spark.sql(query, top=top.repartition(spread) if spread else top)


def node_rows(walk: DataFrame, key: str = "document") -> DataFrame:
    """Typed columns of each node with defaults, path text and node text."""
    code = F.variant_get("node", "$.Code", "variant")
    active = F.variant_get("node", "$.Active", "variant")
    typed = walk.select(
        key,
        "place",
        F.when(F.is_variant_null(code), "None")
        .otherwise(F.coalesce(F.variant_get("node", "$.Code", "string"), F.lit("")))
        .alias("code"),
        F.coalesce(F.variant_get("node", "$.Level", "int"), F.lit(0)).alias("level"),
        F.element_at("path", -1).alias("title"),
        F.col("path").alias("hierarchy_path"),
        F.array_join("path", fixed.PATH_JOINER).alias("hierarchy_string"),
        _stripped("$.Definition").alias("definition"),
        _stripped("$.DefinitionExcludes").alias("excludes"),
        F.when(F.is_variant_null(active), F.lit(None))
        .otherwise(F.coalesce(F.variant_get("node", "$.Active", "boolean"), F.lit(True)))
        .alias("active"),
        F.lit(fixed.NODE_SOURCE).alias("source"),
    )
    text = tx.node_text(F.col("hierarchy_string"), F.col("definition"), F.col("excludes"))
    return typed.withColumn("id", F.col("code")).withColumn("text", text)


def _stripped(path: str):
    return tx.strip(F.coalesce(F.variant_get("node", path, "string"), F.lit("")))


def flatten_tree(top: DataFrame, key: str = "document", spread: int | None = None,
                 folder: str | None = None) -> DataFrame:
    """Node rows with ``position``: the pre-order number over all documents."""
    conf, limit = top.sparkSession.conf, "spark.sql.cteRecursionRowLimit"
    before = conf.get(limit)
    conf.set(limit, "-1")
    try:
        nodes = materialize(node_rows(walk_tree(top, key, spread), key), "nodes", folder)
    finally:
        conf.set(limit, before)
    return number_rows(nodes, [key, "place"], "position", folder=folder)
