"""Job: classes for table rows that have none."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx
from shelfmark.functions.vectors import with_vector
from shelfmark.operators import answers as an
from shelfmark.operators import chat, prompts, reports
from shelfmark.operators.candidates import path_prefix, with_candidates
from shelfmark.operators.knn import BLOCK_BYTES, nearest
from shelfmark.operators.numbering import in_batches, key_problems
from shelfmark.session import fingerprint, materialize, materialize_in_waves, open_run, run_folder
from shelfmark.sources.keyed import KeyedUpdate, read_keyed, update_keyed
from shelfmark.sources.tables import apply_pending_updates, last_update, pending_rows


# What a hit shows where the corpus was resolved without the field.
_ABSENT = {"level": 0, "code": "", "title": ""}


@dataclass
class Classification:
    """What a run gives: the new table and what it says about each pending row."""

    table: DataFrame
    updates: DataFrame
    results: DataFrame
    unmatched: DataFrame
    unresolved: DataFrame
    failures: DataFrame
    responses: DataFrame
    categories: DataFrame
    summary: DataFrame
    refused: DataFrame


def prepared_batches(table: DataFrame, corpus: DataFrame, key: str, prompt_columns: Sequence[str],
                     target: str, vector: str, dimensions: int | None, k: int, batch_rows: int,
                     texts: prompts.PromptTexts = prompts.STANDARD, folder: str | None = None,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Pending rows by batch: ``batch`` and ``products``, an array of key, vector_status, candidates and block.

    Vectors, search, candidates and prompt texts are found where the rows are.
    One shuffle, of what came of that and not of the vectors, then brings the
    rows into batches, which are gathered within their partitions. Rows whose
    key is NULL or repeated are left out.
    """
    pending = pending_rows(table, target, [key, *prompt_columns, vector])
    parsed = with_vector(pending, vector, dimensions, "__vector", "vector_status")
    context = parsed.select(
        key, "vector_status", "__vector", tx.context_entries(pending, prompt_columns).alias("context")
    )
    # Hits carry only what candidates are made of.
    documents = corpus.select(
        "position", "id", "embedding",
        *[F.col(f) if f in corpus.columns else F.lit(absent).alias(f) for f, absent in _ABSENT.items()],
        path_prefix(F.col("hierarchy_path")).alias("hierarchy_path"),
    )
    found = with_candidates(nearest(context, documents, "__vector", k, block_bytes, folder=folder))
    block = texts.block(_id_text(pending, key), F.col("context"), F.col("candidates"))
    products = found.select(
        key, "vector_status", "candidates", F.when(F.col("vector_status") == "ok", block).alias("block"))
    placed = in_batches(products, pending.select(key), key, batch_rows, "__batch", "__part", folder=folder)
    product = F.struct(key, "vector_status", "candidates", "block")
    # Partitioned by ``__part`` already.
    grouped = placed.groupBy("__part", "__batch").agg(F.array_sort(F.collect_list(product), _by(key)).alias("products"))
    return grouped.select(F.col("__batch").alias("batch"), "products")


def _by(key: str) -> Callable:
    return lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)


def batch_products(batches: DataFrame) -> DataFrame:
    """One row per product: key, vector_status, candidates, block and batch."""
    return batches.select("batch", F.explode("products").alias("product")).select("product.*", "batch")


def product_prompts(batches: DataFrame, texts: prompts.PromptTexts = prompts.STANDARD) -> DataFrame:
    """Prompts of the batches without a failed vector."""
    whole = batches.where(~F.exists("products", lambda p: p["vector_status"] == "failed")
                          & F.exists("products", lambda p: p["block"].isNotNull()))
    blocks = F.transform(F.filter("products", lambda p: p["block"].isNotNull()), lambda p: p["block"])
    return prompts.block_prompts(whole, blocks, texts=texts)


def _id_text(df: DataFrame, key: str):
    kind = df.schema[key].dataType.simpleString()
    return tx.float_text(F.col(key)) if kind in ("float", "double") else F.col(key).cast("string")


def failed_vectors(batches: DataFrame) -> DataFrame:
    """Batches that hold a vector which cannot be read."""
    return batches.where(F.exists("products", lambda p: p["vector_status"] == "failed")).select(
        "batch", F.lit("malformed vector").alias("error"))


def classify(table: DataFrame, corpus: DataFrame, key: str, make_provider: Callable,
             prompt_columns: Sequence[str] = fixed.PROMPT_COLUMNS,
             targets: Sequence[str] = fixed.TARGET_COLUMNS, vector: str = fixed.VECTOR_COLUMN,
             dimensions: int | None = None, k: int = fixed.TOP_K, batch_rows: int = fixed.PROMPT_ROWS,
             coerce_ids: bool = False, only_null: bool = False, plain: bool = False,
             block_bytes: int = BLOCK_BYTES, call_partitions: int | None = None,
             folder: str | None = None, waves: int = 1, resume: bool = False,
             failure_path: str | None = None, texts: prompts.PromptTexts | None = None,
             refuse: bool = True) -> Classification:
    """Classify the rows whose first target column is NULL.

    ``corpus`` comes from ``resolve_metadata``. Every pending row is tried
    once; rows that stay NULL are pending again in the next run. Products with
    their candidates, prompts and responses are written under ``folder`` as
    they are made: later steps read them back and no call is repeated. The
    responses are committed in ``waves``; a run that broke off goes on with the
    same ``folder`` and ``resume``, and refuses other inputs or settings.
    ``texts`` replaces the prompt's own texts. ``call_partitions`` sets how many tasks
    call the model at once. Failures also go to ``failure_path``, if there are
    any.

    An answer names its product by key, so a pending row whose key is NULL or
    repeated stops the job before any call; without ``refuse`` such rows stay
    pending and their keys are listed in ``refused``.
    """
    texts = texts or (prompts.PLAIN if plain else prompts.STANDARD)
    pending = pending_rows(table, targets[0], [key, *prompt_columns, vector])
    refused = key_problems(pending, key)
    if refuse:
        odd = refused.limit(5).collect()
        if odd:
            raise ValueError("pending rows need a key of their own: " + ", ".join(
                f"{r['problem']} {r[key]} ({r['rows']} rows)" for r in odd))
    given, folder = folder, folder or run_folder(table.sparkSession)
    if dimensions is None:
        # A vector of another size than the corpus has fails its batch.
        dimensions = corpus.agg(F.max(F.size("embedding"))).first()[0]
    if given:
        open_run(table.sparkSession, folder, resume, {
            "job": "classify", "key": key, "prompt_columns": list(prompt_columns), "targets": list(targets),
            "vector": vector, "dimensions": dimensions, "k": k, "batch_rows": batch_rows, "coerce_ids": coerce_ids,
            "plain": plain, "texts": [texts.system, texts.head, texts.tail], "waves": waves,
            "rows": fingerprint(pending),
            "corpus": fingerprint(corpus)})
    batches = materialize(
        lambda: prepared_batches(table, corpus, key, prompt_columns, targets[0], vector, dimensions, k, batch_rows,
                                 texts, folder, block_bytes),
        "batches", folder, resume,
    )
    products = batch_products(batches)
    asked = materialize(lambda: product_prompts(batches, texts), "prompts", folder, resume)

    def answered(part: DataFrame) -> DataFrame:
        part = part.repartition(call_partitions) if call_partitions else part
        return chat.complete(part, make_provider)

    responses = materialize_in_waves(asked, "batch", answered, "responses", folder, waves, resume)
    parsed = materialize(lambda: an.parse_responses(responses), "parsed", folder, resume)

    usable = products.where(F.col("vector_status") == "ok")
    matches = materialize(
        lambda: an.match_answers(an.answer_rows(parsed), usable, key, coerce_ids=coerce_ids), "matches", folder, resume
    )
    results = an.matched_results(matches, key, targets=targets)
    failed_batches = failed_vectors(batches).unionByName(
        parsed.where(F.col("error").isNotNull()).select("batch", "error")
    )
    failures = reports.failure_rows(products, failed_batches, key)
    if failure_path:
        reports.write_failures(failures, failure_path)
    unresolved = (
        products.select(key, "batch", "vector_status")
        .join(results.select(key), key, "left_anti")
        .join(failed_batches.select("batch"), "batch", "left_anti")
        .select(key, "batch", "vector_status")
    )
    updates = last_update(results.drop("batch"), key, ["ordinal"]).select(key, *targets)
    return Classification(
        table=apply_pending_updates(table, updates, key, list(targets), targets[0], only_null),
        updates=updates,
        results=results,
        unmatched=an.unmatched_answers(matches),
        unresolved=unresolved,
        failures=failures,
        responses=responses,
        categories=reports.category_counts(results, targets[0]),
        summary=reports.run_summary(products, results, failures, batch_rows),
        refused=refused,
    )


def classify_in_place(spark: SparkSession, path: str, corpus: DataFrame, key: str, make_provider: Callable,
                      targets: Sequence[str] = fixed.TARGET_COLUMNS, only_null: bool = False,
                      **options) -> tuple[Classification, KeyedUpdate]:
    """Classify the pending rows of the keyed table at ``path``; only key ranges with new classes are rewritten.

    Takes the ``options`` of :func:`classify`. The ``table`` of the result is the updated one.
    """
    run = classify(read_keyed(spark, path), corpus, key, make_provider, targets=targets, only_null=only_null, **options)
    # What the run says of its rows lies under its folder and does not read the table again, but for ``refused``.
    refused = materialize(run.refused, "refused", options.get("folder"))
    done = update_keyed(run.updates, path, list(targets), only_null)
    return replace(run, table=read_keyed(spark, path), refused=refused), done
