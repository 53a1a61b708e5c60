"""Consecutive numbers and batches in key order without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import materialize

# monotonically_increasing_id holds the partition number above this bit and the
# row number within the partition below it.
_PARTITION_BIT = 33


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no",
                partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the order of the unique key ``order``.

    One shuffle: rows are range-partitioned by the key, sorted and written with
    their place inside the partition. The row counts per partition, one row
    each, give every partition its first number. Without ``partitions`` the
    adaptive planner joins small neighbouring ranges, which keeps their order.
    Range partitioning samples its input, so ``df`` should be a scan rather
    than a long computation.
    """
    bounds = [partitions, *order] if partitions else list(order)
    ranged = (
        df.repartitionByRange(*bounds)
        .sortWithinPartitions(*order)
        .withColumn("__spot", F.monotonically_increasing_id())
    )
    # Written, because both branches below need the same partition bounds.
    stored = materialize(ranged, f"ranged-{name.strip('_')}", folder).withColumn("__range", F.shiftright("__spot", _PARTITION_BIT))
    # The unpartitioned window sees one row per range.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("__range").agg(F.count("*").alias("__rows")).select(
        "__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")
    )
    inside = F.col("__spot").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return (
        stored.join(F.broadcast(starts), "__range")
        .withColumn(name, F.col("__start") + inside)
        .drop("__range", "__start", "__spot")
    )


def assign_batches(keys: DataFrame, key: str, size: int, name: str = "batch",
                   folder: str | None = None) -> DataFrame:
    """Key and batch number, from 1: each batch holds ``size`` consecutive keys."""
    numbered = number_rows(keys.select(key), [key], "__row_no", folder=folder)
    return numbered.select(key, (F.floor(F.col("__row_no") / size) + 1).cast("bigint").alias(name))


def key_problems(rows: DataFrame, key: str) -> DataFrame:
    """Keys that cannot tell rows apart: ``key`` (NULL or repeated), ``rows`` and ``problem``."""
    counted = rows.groupBy(key).agg(F.count("*").alias("rows"))
    problem = F.when(F.col(key).isNull(), "no key").when(F.col("rows") > 1, "repeated key")
    return counted.withColumn("problem", problem).where(F.col("problem").isNotNull())


def range_of(key: Column, bounds: Sequence[Any]) -> Column:
    """How many of the ascending ``bounds`` are not above ``key``, by bisection."""

    def bisect(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < F.lit(bounds[middle]), bisect(low, middle)).otherwise(bisect(middle + 1, high))

    return bisect(0, len(bounds))


def in_batches(rows: DataFrame, keys: DataFrame, key: str, size: int, name: str = "batch", part: str = "part",
               partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """``rows`` with ``name``: batches of ``size`` consecutive keys, from 1, none of which lies in two partitions.

    ``keys`` has the keys of ``rows``, preferably as a plain scan: they are
    numbered first. Every ``R``-th of them, ``R`` a multiple
    of ``size``, starts a partition, so one shuffle brings the rows themselves
    into key order with whole batches, and their numbers follow from their
    place. ``part`` is the partition: grouping by ``part`` and ``name`` needs
    no further shuffle. Rows whose key is NULL or repeated are left out (see
    :func:`key_problems`).
    """
    spark = rows.sparkSession
    most = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    single = keys.groupBy(key).agg(F.count("*").alias("__rows")).where(
        F.col(key).isNotNull() & (F.col("__rows") == 1)).select(key)
    numbered = number_rows(single, [key], "__row_no", folder=folder)
    count = numbered.count()
    each = max(1, -(-count // (most * size))) * size
    first = (F.col("__row_no") % each == 0) & (F.col("__row_no") > 0)
    bounds = sorted(r[0] for r in numbered.where(first).select(key).collect())  # fewer than ``most``
    # Number of rows with the key, within the partition: the shuffle by ``part`` already holds them together.
    same = Window.partitionBy(part, key)
    ranged = (
        rows.where(F.col(key).isNotNull()).withColumn(part, range_of(F.col(key), bounds))
        .repartitionById(len(bounds) + 1, F.col(part))
        .withColumn("__same", F.count("*").over(same)).where(F.col("__same") == 1).drop("__same")
        .sortWithinPartitions(part, key)
        .withColumn("__spot", F.monotonically_increasing_id())
    )
    inside = F.col("__spot").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return ranged.withColumn(
        name, (F.floor((F.col(part).cast("bigint") * each + inside) / size) + 1).cast("bigint")).drop("__spot")
