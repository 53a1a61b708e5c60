"""One query per training-data operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    cross_polytope, fill_middle, language_centroids, packing, pii_surrogates, quality_rff, sentencepiece_prefix,
    simhash_vptree, streaming_dedup, toxicity_crf, url_filter, warc_fixity, whitening)

PACK_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
SURROGATE_KEY = "surrogates of this corpus"
# The rules, and the words in the names of hosts whose pages make up the list.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
LISTED_HOSTS = r"(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), PACK_TOKENIZER, end_id=2, max_tokens=1024)


def op2_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii_surrogates.replace_private(_table(spark, folder, "documents"), SURROGATE_KEY).select(
        "doc_id", "text", "private_kinds", F.size("private_kinds").alias("replaced"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_vptree.simhash_groups(_table(spark, folder, "documents"), shingle_words=4, max_distance=4)


def op4_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = cross_polytope.search(vectors, vectors.where(F.pmod("id", F.lit(50)) == 0), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_crf.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return streaming_dedup.exact_dedup(_table(spark, folder, "documents"))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    ids = sentencepiece_prefix.encode_documents(_table(spark, folder, "documents"), PIECE_MODEL)
    return sentencepiece_prefix.digests(sentencepiece_prefix.decode_ids(ids, PIECE_MODEL))


def op8_language_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return language_centroids.language_of(_table(spark, folder, "documents"))


def op9_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Audits the archives of all pages against a copy with lost, overwritten and shortened records."""
    pages = _table(spark, folder, "pages")
    page = F.col("page_id")
    damaged = F.when(page % 97 == 13, F.overlay("html", F.lit("#"), 20)).when(
        page % 103 == 5, F.substring("html", 1, 100)).otherwise(F.col("html"))
    copy = pages.where(page.isNull() | (page % 101 != 7)).withColumn("html", damaged)
    return warc_fixity.fixity_audit(warc_fixity.archive_records(pages), warc_fixity.archive_records(copy))


def op10_quality_rff(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rff.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """``deviation`` is null where it is beyond 64 bits; ``deviation_exact`` never is."""
    vectors = _table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return whitening.whiten(vectors, components=8, steps=1024, shift=100_000).select(
        F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(
        _table(spark, folder, "documents"), seed=7, changed_percent=100, spm_percent=50))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The list holds the pages of hosts with certain words in their names, in their canonical form."""
    pages = _table(spark, folder, "pages")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.judge_urls(pages, URL_RULES, listed)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_simhash": op3_simhash,
    "op4_cross_polytope": op4_cross_polytope,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_language_centroids": op8_language_centroids,
    "op9_warc_fixity": op9_warc_fixity,
    "op10_quality_rff": op10_quality_rff,
    "op11_whitening": op11_whitening,
    "op12_fill_middle": op12_fill_middle,
    "op13_url_filter": op13_url_filter,
}
