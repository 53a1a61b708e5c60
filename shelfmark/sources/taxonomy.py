"""Taxonomy JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_taxonomy(spark: SparkSession, path: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """One row per JSON file: ``document`` (file name) and ``content`` (whole text).

    A taxonomy may be split over any number of files; each has its own
    ``Schema``, and they are read in parallel.
    """
    if encoding.lower().replace("_", "-") in ("utf-8", "utf-8-sig"):
        files = spark.read.text(path, wholetext=True).withColumnRenamed("value", "content")
        return files.select(F.input_file_name().alias("document"), "content")
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("document"), F.decode("content", encoding).alias("content")
    )


def top_nodes(documents: DataFrame, key: str = "document", content: str = "content") -> DataFrame:
    """Top-level nodes of each document: ``key``, ``place``, ``node`` (variant).

    ``Schema`` may be a list or one node. A document without it stops the job,
    and so does one that is no JSON. Each node becomes a variant of its own,
    so the size limit of variants does not apply to the whole document.
    """
    text = F.regexp_replace(F.col(content), "^\ufeff", "")
    listed = F.from_json(text, "Schema array<variant>")["Schema"]
    single = F.from_json(text, "Schema variant")["Schema"]
    one = F.when(F.startswith(F.schema_of_variant(single), F.lit("OBJECT")), F.array(single))
    missing = F.raise_error(
        F.concat(F.lit("taxonomy without readable top-level 'Schema': "), F.col(key).cast("string"))
    )
    nodes = F.coalesce(listed, one, missing.cast("array<variant>"))
    return documents.select(key, F.posexplode_outer(nodes).alias("place", "node")).where(F.col("place").isNotNull())
