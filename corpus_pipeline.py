"""From raw documents to packed training sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import packing, pii_surrogates, simhash_vptree, streaming_dedup, toxicity_crf
from shelfmark.llm.common import stored
from shelfmark.llm.queries import PACK_TOKENIZER, SURROGATE_KEY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    Null and empty texts stay, repeated rows are judged each, all columns stay
    whatever their names; an empty table gives no rows, no labels reject none.
    """
    return toxicity_crf.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, A-Z and a-z taken as equal: the one with the largest ``doc_id``.

    Null counts as empty and a null id as the smallest; rows that repeat id and
    text are one. An empty table gives no rows, all columns stay.
    """
    return streaming_dedup.keep_first_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest ``doc_id``.

    Null and empty texts are near copies of each other, rows with a null id
    stay, of a repeated id one row. An empty table gives no rows, all columns stay.
    """
    return simhash_vptree.keep_one_of_each(docs, shingle_words=4, max_distance=4)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data; ``n_chars``, if there, follows the new text.

    Null and empty texts stay as they are, repeated rows get the same text,
    other columns stay; an empty table gives no rows.
    """
    replaced = pii_surrogates.replace_private(docs, SURROGATE_KEY).drop(pii_surrogates.KINDS)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return replaced


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences, as ``op1`` returns them.

    Null and empty texts are one token, repeated rows and ids are packed each,
    extra columns ignored; an empty table gives no rows.
    """
    return packing.pack_documents(docs, PACK_TOKENIZER, end_id=2, max_tokens=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("pii", replace_private),
    ("packing", pack),
]

#: The learned filter and the tokenizer have no SQL form; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
