"""Counts and listings of a classification run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx


def category_counts(results: DataFrame, category: str, batch: str = "batch",
                    shown: int = fixed.TOP_CATEGORIES) -> DataFrame:
    """Largest categories per batch and the number of those not shown.

    Rows: ``batch``, ``rank``, ``category`` (display label), ``classified``,
    ``others``. Equal counts are ordered by first appearance. After the
    aggregate a batch has at most as many rows as products.
    """
    counts = (
        results.where(F.col(category) != "")
        .groupBy(batch, F.col(category).alias("__category"))
        .agg(F.count("*").alias("classified"), F.min("ordinal").alias("__first"))
    )
    ranked = Window.partitionBy(batch).orderBy(F.desc("classified"), "__first")
    everything = Window.partitionBy(batch)
    return (
        counts.withColumn("rank", F.row_number().over(ranked))
        .withColumn("others", F.greatest(F.count("*").over(everything) - shown, F.lit(0)))
        .where(F.col("rank") <= shown)
        .select(batch, "rank", tx.short_label(F.col("__category")).alias("category"), "classified", "others")
    )


def failure_rows(rows: DataFrame, failed_batches: DataFrame, key: str, batch: str = "batch") -> DataFrame:
    """Every row of a failed batch with its error."""
    return rows.join(failed_batches.select(batch, "error"), batch).select(
        F.col(key).alias("product_id"), batch, "error"
    )


def write_failures(failures: DataFrame, path: str) -> bool:
    """Write the failure log as JSON, replacing an older one; nothing if there is none."""
    if failures.isEmpty():
        return False
    failures.write.mode("overwrite").json(path)
    return True


def run_summary(pending: DataFrame, results: DataFrame, failures: DataFrame, batch_rows: int) -> DataFrame:
    """One row: ``classified``, ``failed``, ``total`` and ``batches``.

    Rows that the model left out or answered with an unknown letter count
    neither as classified nor as failed.
    """
    kinds = [("pending", pending), ("classified", results), ("failed", failures)]
    tally = None
    for kind, df in kinds:
        part = df.agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
        tally = part if tally is None else tally.unionByName(part)
    count = {kind: F.max(F.when(F.col("kind") == kind, F.col("n"))) for kind, _ in kinds}
    return tally.agg(
        count["classified"].alias("classified"),
        count["failed"].alias("failed"),
        (count["classified"] + count["failed"]).alias("total"),
        F.ceil(count["pending"] / batch_rows).alias("batches"),
    )


def classified_listing(table: DataFrame, key: str, target: str, columns: list[str], rows: int = 10) -> DataFrame:
    """First classified rows in key order, to look at."""
    return table.where(F.col(target).isNotNull()).select(key, *columns).orderBy(key).limit(rows)
