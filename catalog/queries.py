"""Catalogued queries: one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from shelfmark.functions import text as tx
from shelfmark.functions import vectors as vx
from shelfmark.operators import answers as an
from shelfmark.operators import candidates as cd
from shelfmark.operators import chat, embedding, knn, numbering, prompts, reports, tree
from shelfmark.plans import build_vectors as jb
from shelfmark.plans import classify as jc
from shelfmark.plans import embed_rows as je
from shelfmark.session import run_folder
from shelfmark.sources import corpus as cp
from shelfmark.sources import keyed
from shelfmark.sources import tables as tb
from shelfmark.sources import taxonomy
from shelfmark.sources import taxonomy_scan as taxonomy_scanner

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _rounded(column: str):
    return (F.round(F.col(column), 6) + F.lit(0.0)).alias(column)


# Vectors and search


@query
def l2_normalize(spark, folder):
    unit = fx.table(spark, folder, "embeddings").select("vec_id", vx.l2_normalize(F.col("embedding")).alias("unit"))
    return unit.select("vec_id", F.posexplode("unit").alias("component", "value")).select(
        "vec_id", "component", _rounded("value")
    )


@query
def squared_distance(spark, folder):
    vectors = fx.table(spark, folder, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    distance = vx.squared_l2(vx.l2_normalize(F.col("embedding")), vx.l2_normalize(F.col("next")))
    return vectors.join(following, "vec_id").select("vec_id", distance.alias("score")).select("vec_id", _rounded("score"))


@query
def knn_single(spark, folder):
    first = fx.table(spark, folder, "embeddings").agg(F.min_by("embedding", "vec_id")).first()[0]
    return knn.search(fx.resolved_corpus(spark, folder), first).select("position", "id", _rounded("score"))


def _ranked_hits(found):
    return fx.hit_rows(found).select("query_id", "rank", "position", "id", _rounded("score"))


@query
def knn_batch(spark, folder):
    return _ranked_hits(fx.hits(spark, folder))


@query
def knn_blocks(spark, folder):
    """The same search with blocks of 64 KiB, none of which a worker keeps."""
    return _ranked_hits(knn.nearest(
        fx.query_vectors(spark, folder), fx.resolved_corpus(spark, folder), block_bytes=1 << 16, kept_bytes=0))


def _hit_metadata(found):
    return fx.hit_rows(found).select("query_id", "rank", "id", "level", "code", "title", "hierarchy_string")


@query
def knn_metadata_code(spark, folder):
    return _hit_metadata(fx.hits(spark, folder))


@query
def knn_metadata_position(spark, folder):
    return _hit_metadata(fx.hits(spark, folder, "position"))


# Candidates


@query
def candidate_groups(spark, folder):
    rows = cd.candidate_rows(fx.candidates(spark, folder), "query_id")
    return rows.select("query_id", "hierarchy_string", _rounded("score"), F.size("hierarchy_path").alias("depth"))


@query
def candidate_attributes(spark, folder):
    rows = cd.candidate_rows(fx.candidates(spark, folder), "query_id")
    found = rows.select("query_id", "hierarchy_string", F.posexplode("attributes").alias("place", "attribute"))
    return found.select("query_id", "hierarchy_string", "place", "attribute.*")


@query
def candidate_letters(spark, folder):
    rows = cd.candidate_rows(fx.candidates(spark, folder), "query_id")
    return rows.select("query_id", "rank", "letter", "hierarchy_string", _rounded("score"))


@query
def candidate_lists(spark, folder):
    parsed = vx.with_vector(fx.products(spark, folder), "embedding_context", fx.DIMENSION)
    found = knn.nearest(parsed.select("product_id", "vector"), fx.resolved_corpus(spark, folder))
    return cd.with_candidates(found).select(
        "product_id",
        F.size("candidates").alias("options"),
        F.array_join(F.col("candidates.letter"), " ").alias("letters"),
        F.array_join(F.col("candidates.hierarchy_string"), "; ").alias("paths"),
    )


@query
def level_columns(spark, folder):
    rows = cd.candidate_rows(fx.candidates(spark, folder), "query_id")
    chosen = F.struct("hierarchy_path", "attributes")
    return rows.select("query_id", (F.col("rank") - 1).alias("place"), *cd.level_columns(chosen, fx.TARGETS))


# Taxonomy corpus


@query
def tree_flatten(spark, folder):
    nodes = tree.flatten_tree(taxonomy.top_nodes(fx.tree_documents(spark, folder)))
    return nodes.select(
        "position", "document", "id", "level", tx.level_name(F.col("level")).alias("level_name"), "title",
        "hierarchy_string", F.size("hierarchy_path").alias("depth"), "definition", "excludes", "active", "text",
    )


@query
def taxonomy_scan(spark, folder):
    """The same nodes from few large files, cut by byte ranges."""
    path = fx.taxonomy_files(spark, folder, f"{run_folder(spark)}/taxonomy")
    nodes = tree.flatten_tree(taxonomy_scanner.scan_nodes(spark, path))
    return nodes.select("id", "level", "title", "hierarchy_string", "definition", "excludes", "active", "text")


@query
def node_text(spark, folder):
    part = fx.table(spark, folder, "part")
    definition = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("")
    excludes = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("size "), "p_size")).otherwise("")
    return part.select("p_partkey", tx.node_text(F.concat_ws(" > ", "p_type", "p_brand"), definition, excludes).alias("text"))


@query
def lookup_build(spark, folder):
    fields = ["level", "code", "title", "hierarchy_string", "unit"]
    return cp.lookup_rows(fx.corpus(spark, folder), fields)


@query
def manifest(spark, folder):
    return cp.manifest_row(fx.corpus(spark, folder), "hash-64", "gs1").drop("timestamp")


@query
def corpus_roundtrip(spark, folder):
    place = run_folder(spark)
    cp.save_corpus(fx.corpus(spark, folder), place, "hash-64", "gs1")
    stored, lookup = cp.load_corpus(spark, place, "hash-64", fx.DIMENSION)
    archive = spark.read.parquet(f"{place}/archive")
    dump = spark.read.json(f"{place}/metadata")
    total = F.aggregate(F.from_json("embedding", "array<float>"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return (
        stored.select(F.lit("corpus").alias("part"), "id", "text", F.col("position").cast("double").alias("number"))
        .unionByName(archive.select(F.lit("archive").alias("part"), "id", "text", total.alias("number")))
        .unionByName(dump.select(
            F.lit("metadata").alias("part"), "id", F.col("metadata.hierarchy_string").alias("text"),
            F.col("metadata.level").cast("double").alias("number"),
        ))
        .unionByName(lookup.select(
            F.lit("lookup").alias("part"), F.col("key").alias("id"), F.col("title").alias("text"),
            F.col("level").cast("double").alias("number"),
        ))
        .select("part", "id", "text", _rounded("number"))
    )


@query
def vector_check(spark, folder):
    parsed = vx.with_vector(fx.products(spark, folder), "embedding_context")
    return embedding.vector_problems(parsed, "vector", fx.DIMENSION)


# Rows


@query
def pending_embed(spark, folder):
    return tb.pending_rows(fx.labelled_documents(spark, folder), "quality", ["doc_id", "lang", "source", "n_chars"])


@query
def pending_classify(spark, folder):
    columns = ["product_id", *fx.PROMPT_COLUMNS]
    return tb.pending_rows(fx.products(spark, folder), "gs1_segment", columns)


@query
def pending_count(spark, folder):
    return tb.pending_count(fx.labelled_documents(spark, folder), "quality")


@query
def page_rows(spark, folder):
    return tb.page_of_rows(fx.table(spark, folder, "customer"), "c_custkey", 40, 25)


@query
def param_sql(spark, folder):
    statement = "SELECT p_partkey, p_name, p_size FROM {part} WHERE p_size >= :low AND p_type <> :kind"
    return tb.run_sql(spark, statement, {"low": 10, "kind": "ECONOMY"}, part=fx.table(spark, folder, "part"))


@query
def row_text(spark, folder):
    part = fx.table(spark, folder, "part").withColumn("kind", F.nullif("p_type", F.lit("ECONOMY"))).withColumn(
        "rest", F.col("p_size") % 5
    )
    return part.select("p_partkey", tx.row_text(part, ["p_name", "kind", "p_brand", "rest", "p_retailprice"]).alias("text"))


@query
def row_embedding(spark, folder):
    pending = fx.labelled_documents(spark, folder).where(F.col("quality").isNull())
    spread = pending.select("doc_id", "text").repartition(spark.sparkContext.defaultParallelism)
    vector = embedding.embed(F.col("text"), embedding.hashing_provider(fx.DIMENSION))
    return spread.select("doc_id", vx.vector_json(vector).alias("vector"))


@query
def vector_parse(spark, folder):
    parsed = vx.with_vector(fx.products(spark, folder), "embedding_context", fx.DIMENSION)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return parsed.select("product_id", "vector_status", total.alias("total")).select(
        "product_id", "vector_status", _rounded("total")
    )


@query
def prompt_context(spark, folder):
    part = fx.table(spark, folder, "part")
    entries = part.select("p_partkey", F.posexplode(tx.context_entries(part, fx.PROMPT_COLUMNS)).alias("place", "entry"))
    return entries.select("p_partkey", "place", "entry.key", "entry.value")


# Prompts and model calls


@query
def prompt_batches(spark, folder):
    pending = fx.labelled_documents(spark, folder).where(F.col("quality").isNull())
    return numbering.assign_batches(pending, "doc_id", 10)


def _prompts(spark, folder, texts=prompts.STANDARD):
    batches = jc.prepared_batches(
        fx.products(spark, folder), fx.resolved_corpus(spark, folder), "product_id", fx.PROMPT_COLUMNS,
        "gs1_segment", "embedding_context", fx.DIMENSION, 30, 10, texts,
    )
    return jc.product_prompts(batches, texts)


@query
def prompt_text(spark, folder):
    return _prompts(spark, folder).select("batch", "products", F.md5("system_message").alias("system_md5"), "user_message")


@query
def prompt_fallback(spark, folder):
    asked = _prompts(spark, folder, prompts.PLAIN)
    return asked.select("batch", "products", F.md5("system_message").alias("system_md5"), "user_message")


@query
def chat_offline(spark, folder):
    return chat.complete(_prompts(spark, folder), chat.first_option_provider()).drop("error")


@query
def token_usage(spark, folder):
    return chat.token_usage(chat.complete(_prompts(spark, folder), chat.first_option_provider()))


# Responses


@query
def response_json(spark, folder):
    return an.parse_responses(fx.responses(spark, folder)).select(
        "batch", F.size("answers").alias("answers"), "error"
    ).withColumn("answers", F.when(F.col("error").isNull(), F.col("answers")))


@query
def response_regex(spark, folder):
    wrapped = fx.responses(spark, folder).withColumn("content", F.concat(F.lit("Answer:\n"), "content", F.lit("\nend")))
    return an.parse_responses(wrapped).select(
        "batch", F.when(F.col("error").isNull(), F.size("answers")).alias("answers"), "error"
    )


@query
def response_failures(spark, folder):
    parsed = an.parse_responses(fx.responses(spark, folder))
    rows = fx.table(spark, folder, "embeddings").select("vec_id", F.expr("vec_id DIV 10 + 1").alias("batch"))
    return reports.failure_rows(rows, parsed.where(F.col("error").isNotNull()), "vec_id")


@query
def answers(spark, folder):
    return an.answer_rows(an.parse_responses(fx.responses(spark, folder))).select("batch", "ordinal", "id_text", "choice")


@query
def choice_join(spark, folder):
    found = fx.matches(spark, folder).where(F.col("candidate").isNotNull())
    return found.select("batch", "ordinal", "product_id", "choice", F.col("candidate.hierarchy_string").alias("path"))


@query
def choice_unmatched(spark, folder):
    return an.unmatched_answers(fx.matches(spark, folder))


@query
def result_dedupe(spark, folder):
    results = an.matched_results(fx.matches(spark, folder), "product_id", targets=fx.TARGETS)
    return tb.last_update(results.drop("batch"), "product_id", ["ordinal"])


# Write-back and reports


@query
def keyed_update(spark, folder):
    orders = fx.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderpriority").alias("c_mktsegment"),
        F.col("o_totalprice").alias("c_acctbal"),
    )
    updates = tb.last_update(orders, "c_custkey", ["o_orderkey"])
    return tb.apply_updates(fx.table(spark, folder, "customer"), updates, "c_custkey", ["c_mktsegment", "c_acctbal"])


@query
def keyed_in_place(spark, folder):
    """The same update made in a keyed table of ranges of 500 customers."""
    place = f"{run_folder(spark)}/customers"
    keyed.create_keyed(fx.table(spark, folder, "customer"), place, "c_custkey", rows_per_range=500)
    orders = fx.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderpriority").alias("c_mktsegment"),
        F.col("o_totalprice").alias("c_acctbal"),
    )
    keyed.update_keyed(tb.last_update(orders, "c_custkey", ["o_orderkey"]), place, ["c_mktsegment", "c_acctbal"])
    return keyed.read_keyed(spark, place)


@query
def category_counts(spark, folder):
    events = fx.table(spark, folder, "events")
    label = (
        F.when(F.col("event_type") == "view", "Health & Beauty Care")
        .when(F.col("event_type") == "click", "Beverages - Non-Alcoholic - Prepared/Processed")
        .when(F.col("value") < 1, "")
        .otherwise(F.col("event_type"))
    )
    results = events.select(F.expr("event_id DIV 20").alias("batch"), F.col("event_id").alias("ordinal"), label.alias("label"))
    return reports.category_counts(results, "label")


@query
def run_summary(spark, folder):
    parsed = an.parse_responses(fx.responses(spark, folder))
    rows = fx.table(spark, folder, "embeddings").select("vec_id", F.expr("vec_id DIV 10 + 1").alias("batch"))
    failures = reports.failure_rows(rows, parsed.where(F.col("error").isNotNull()), "vec_id")
    results = an.matched_results(fx.matches(spark, folder), "product_id", targets=fx.TARGETS)
    return reports.run_summary(rows, results, failures, 10)


@query
def verify_listing(spark, folder):
    return reports.classified_listing(fx.products(spark, folder), "product_id", "gs1_segment", ["gs1_segment", "gs1_family"])


# Jobs


@query
def job_build(spark, folder):
    place = run_folder(spark)
    corpus, _ = jb.build_vectors(
        fx.tree_documents(spark, folder), place, embedding.hashing_provider(fx.DIMENSION), fx.DIMENSION, "hash-64"
    )
    return corpus.select("position", "id", "text", "level", vx.vector_json(F.col("embedding")).alias("vector"))


@query
def job_embed(spark, folder):
    documents = fx.labelled_documents(spark, folder).select(
        "doc_id", "lang", "text", F.concat(F.lit("["), "quality", F.lit("]")).alias("embedding_context")
    )
    done = je.embed_rows(
        documents, "doc_id", ["lang", "text"], embedding.hashing_provider(fx.DIMENSION), fx.DIMENSION,
        call_partitions=spark.sparkContext.defaultParallelism,
    )
    return done.select("doc_id", "embedding_context")


@query
def job_embed_in_place(spark, folder):
    """Vectors written into a keyed table; what had a vector stays in its files where no row of its range lacked one."""
    place = f"{run_folder(spark)}/documents"
    documents = fx.labelled_documents(spark, folder).select(
        "doc_id", "lang", "text", F.concat(F.lit("["), "quality", F.lit("]")).alias("embedding_context")
    )
    keyed.create_keyed(documents, place, "doc_id", rows_per_range=1000)
    je.embed_in_place(
        spark, place, "doc_id", ["lang", "text"], embedding.hashing_provider(fx.DIMENSION), fx.DIMENSION,
        call_partitions=spark.sparkContext.defaultParallelism,
    )
    return keyed.read_keyed(spark, place).select("doc_id", "embedding_context")


def _classified(spark, folder, **options):
    return jc.classify(
        fx.products(spark, folder), fx.resolved_corpus(spark, folder), "product_id", chat.first_option_provider(),
        fx.PROMPT_COLUMNS, fx.TARGETS, dimensions=fx.DIMENSION, **options,
    )


@query
def job_classify(spark, folder):
    return _classified(spark, folder).table.select("product_id", *fx.TARGETS)


@query
def job_summary(spark, folder):
    return _classified(spark, folder).summary


@query
def job_unresolved(spark, folder):
    return _classified(spark, folder).unresolved


@query
def failure_log(spark, folder):
    place = f"{run_folder(spark)}/failures"
    run = _classified(spark, folder, failure_path=place)
    return spark.read.schema(run.failures.schema).json(place)
