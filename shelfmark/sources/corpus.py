"""Taxonomy corpus on disk: vectors, metadata dump, lookup, build manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx
from shelfmark.functions.vectors import vector_json
from shelfmark.operators.embedding import check_vectors
from shelfmark.session import fingerprint

METADATA = [
    "source", "level", "code", "title", "hierarchy_path",
    "hierarchy_string", "definition", "excludes", "active",
]

#: Parts whose contents are checked when a build is loaded.
CHECKED = ("corpus", "lookup")


def metadata_struct(fields: Sequence[str] = METADATA) -> Column:
    return F.struct(*[F.col(f) for f in fields])


def archive_rows(corpus: DataFrame) -> DataFrame:
    """Archive form with four text columns; vectors as given, not normalised."""
    return corpus.select(
        "id", "text",
        vector_json(F.col("embedding")).alias("embedding"),
        F.to_json(metadata_struct(), {"ignoreNullFields": "false"}).alias("metadata"),
    )


def lookup_rows(corpus: DataFrame, fields: Sequence[str] = fixed.LOOKUP_FIELDS) -> DataFrame:
    """One row per lookup key with the fields of the last document under it.

    A field the corpus lacks is NULL. The aggregate keeps one struct per key
    and partition before the shuffle, however often a key repeats.
    """
    wanted = [F.col(f) if f in corpus.columns else F.lit(None).cast("string").alias(f) for f in fields]
    return (
        corpus.groupBy(tx.lookup_key(F.col("id")).alias("key"))
        .agg(F.max_by(F.struct(*wanted), F.col("position")).alias("entry"))
        .select("key", "entry.*")
    )


def manifest_row(corpus: DataFrame, model: str, prefix: str) -> DataFrame:
    """One row that describes a build."""
    return corpus.agg(
        F.current_timestamp().alias("timestamp"),
        F.lit(model).alias("model"),
        F.max(F.size("embedding")).alias("dimensions"),
        F.count("*").alias("document_count"),
        F.lit("FlatL2").alias("index_type"),
        F.lit(prefix).alias("prefix"),
    )


def save_corpus(corpus: DataFrame, folder: str, model: str, prefix: str,
                lookup_fields: Sequence[str] = fixed.LOOKUP_FIELDS, dimensions: int | None = None) -> None:
    """Write corpus, archive, metadata dump, lookup and manifest under ``folder``.

    The corpus is written first; the check and the other outputs read that
    table, so the vectors are computed once. A missing vector or a wrong size
    stops the build. The manifest comes last: without it there is no build. It
    holds row counts and order-free hashes of corpus and lookup as they were
    written.
    """
    spark = corpus.sparkSession
    corpus.write.mode("overwrite").parquet(f"{folder}/corpus")
    stored = spark.read.schema(corpus.schema).parquet(f"{folder}/corpus")
    check_vectors(stored, "embedding", dimensions)
    archive_rows(stored).write.mode("overwrite").parquet(f"{folder}/archive")
    dump = stored.select("position", "id", metadata_struct().alias("metadata"))
    dump.orderBy("position").write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/metadata")
    lookup_rows(stored, lookup_fields).write.mode("overwrite").parquet(f"{folder}/lookup")
    content = {part: fingerprint(spark.read.parquet(f"{folder}/{part}")) for part in CHECKED}
    manifest = manifest_row(stored, model, prefix).withColumns({f"{part}_content": F.lit(h) for part, h in content.items()})
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")


def load_corpus(spark: SparkSession, folder: str, model: str | None = None,
                dimensions: int | None = None, check_content: bool = True) -> tuple[DataFrame, DataFrame]:
    """Corpus and lookup of a build, checked against its manifest.

    A missing part is an error, and so is a build with another model or vector
    size than the one asked for, or whose corpus or lookup does not hold the
    rows that were written. That check reads both once; ``check_content`` can
    leave it out for a build that was checked before.
    """
    parts = {part: spark.read.parquet(f"{folder}/{part}") for part in CHECKED}
    manifest = spark.read.json(f"{folder}/manifest").first()
    if model is not None and manifest["model"] != model:
        raise ValueError(f"corpus was built with model {manifest['model']}, not {model}")
    if dimensions is not None and manifest["dimensions"] != dimensions:
        raise ValueError(f"corpus vectors have {manifest['dimensions']} components, not {dimensions}")
    for part, table in parts.items() if check_content else ():
        written, found = manifest[f"{part}_content"], fingerprint(table)
        if written != found:
            rows = [text.split(":")[0] for text in (written, found)]
            raise ValueError(f"{part} in {folder} is not what was built: {rows[1]} of {rows[0]} rows, or other contents")
    return parts["corpus"], parts["lookup"]
