"""Job: vectors for table rows that have none."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx
from shelfmark.functions.vectors import vector_json
from shelfmark.operators.embedding import embed
from shelfmark.session import fingerprint, materialize_in_waves, open_run, run_folder
from shelfmark.sources.keyed import KeyedUpdate, read_keyed, update_keyed
from shelfmark.sources.tables import apply_pending_updates, pending_rows


def pending_texts(table: DataFrame, key: str, columns: Sequence[str], target: str,
                  separator: str = fixed.ROW_TEXT_SEPARATOR) -> DataFrame:
    """Key and ``text`` of each row whose ``target`` is NULL."""
    pending = pending_rows(table, target, [key, *columns])
    return pending.select(key, tx.row_text(pending, columns, separator).alias("text"))


def embed_updates(table: DataFrame, key: str, columns: Sequence[str], make_provider: Callable,
                  dimensions: int, target: str = fixed.VECTOR_COLUMN,
                  separator: str = fixed.ROW_TEXT_SEPARATOR, call_partitions: int | None = None,
                  folder: str | None = None, waves: int = 1, resume: bool = False) -> DataFrame:
    """Key and new ``target`` of the rows where it is NULL, ready for an update in place.

    The vectors are written before the update is planned, so the paid calls are
    not repeated, in ``waves`` commits under ``folder``; a run that broke off
    goes on with the same ``folder`` and ``resume``, and refuses other inputs
    or settings. ``call_partitions`` sets
    how many tasks call the provider at once. Text columns get JSON, array
    columns the vector. A vector of another size than ``dimensions`` stops the
    job at the call that returned it.
    """
    texts = pending_texts(table, key, columns, target, separator)

    def embedded(part: DataFrame) -> DataFrame:
        part = part.repartition(call_partitions) if call_partitions else part
        return part.select(key, embed(F.col("text"), make_provider, dimensions=dimensions).alias("vector"))

    if folder:
        open_run(table.sparkSession, folder, resume, {
            "job": "embed_rows", "key": key, "columns": list(columns), "target": target, "separator": separator,
            "dimensions": dimensions, "waves": waves, "texts": fingerprint(texts)})
    folder = folder or run_folder(table.sparkSession)
    vectors = materialize_in_waves(texts, key, embedded, "vectors", folder, waves, resume)
    text = table.schema[target].dataType.simpleString() == "string"
    value = vector_json(F.col("vector")) if text else F.col("vector").cast(table.schema[target].dataType)
    return vectors.select(key, value.alias(target))


def embed_rows(table: DataFrame, key: str, columns: Sequence[str], make_provider: Callable, dimensions: int,
               target: str = fixed.VECTOR_COLUMN, **options) -> DataFrame:
    """Table with ``target`` filled where it was NULL; other rows stay as they are.

    See :func:`embed_updates` for the ``options``.
    """
    updates = embed_updates(table, key, columns, make_provider, dimensions, target, **options)
    return apply_pending_updates(table, updates, key, [target], target)


def embed_in_place(spark: SparkSession, path: str, key: str, columns: Sequence[str], make_provider: Callable,
                   dimensions: int, target: str = fixed.VECTOR_COLUMN, **options) -> KeyedUpdate:
    """Fill ``target`` in the keyed table at ``path`` where it is NULL; only key ranges with such rows are rewritten.

    See :func:`embed_updates` for the ``options``.
    """
    updates = embed_updates(read_keyed(spark, path), key, columns, make_provider, dimensions, target, **options)
    return update_keyed(updates, path, [target], only_null=True)
