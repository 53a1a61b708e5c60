"""Tables that are updated in place by key, part by part.

The rows lie in one folder for each key range (``part=N``). An update finds
the ranges that it changes and replaces only their files, by Spark's dynamic
partition overwrite; the files of all other ranges are neither read in full
nor written. The bounds of the ranges are a table beside the rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from shelfmark.operators.numbering import range_of
from shelfmark.session import fingerprint, finished, materialize, open_run, run_folder
from shelfmark.sources.tables import apply_updates

PART = "part"
_SAMPLE_KEYS = 100_000


@dataclass
class KeyedUpdate:
    """What an update did: given updates, rows of the table they met, ranges rewritten of all ranges."""

    updates: int
    rows: int
    rewritten: list[int]
    ranges: int


def create_keyed(table: DataFrame, path: str, key: str, rows_per_range: int = 1_000_000,
                 most_ranges: int = 4096) -> DataFrame:
    """Write ``table`` as a keyed table, by ranges of about ``rows_per_range`` rows.

    The bounds are quantiles of at most 100,000 keys, chosen by hash, so they
    hardly depend on how often a key repeats. Rows without key are a range of
    their own, -1, which no update changes. A path that holds a keyed table
    already is an error.
    """
    spark = table.sparkSession
    if PART in table.columns:
        raise ValueError(f"the column name {PART} is taken by the key ranges")
    if finished(spark, f"{path}/bounds"):
        raise ValueError(f"{path} holds a keyed table")
    ranges = min(most_ranges, max(1, -(-table.count() // rows_per_range)))
    keys = table.select(key).where(F.col(key).isNotNull()).distinct()
    sample = sorted(r[0] for r in keys.orderBy(F.xxhash64(key), key).limit(_SAMPLE_KEYS).collect()) if ranges > 1 else []
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)} if sample else set())
    placed = table.withColumn(PART, F.when(F.col(key).isNull(), -1).otherwise(range_of(F.col(key), bounds)))
    # Adaptive rebalancing writes few files a range and splits one that turned out large.
    placed.hint("rebalance", PART).write.partitionBy(PART).mode("overwrite").parquet(f"{path}/rows")
    held = spark.createDataFrame(
        [(i, key, table.schema.json(), b) for i, b in enumerate([None, *bounds])],
        f"place int, key string, columns string, bound {table.schema[key].dataType.simpleString()}")
    # Written last: without it there is no keyed table.
    held.coalesce(1).write.mode("overwrite").parquet(f"{path}/bounds")
    return read_keyed(spark, path)


def _described(spark: SparkSession, path: str) -> tuple[str, list, list[str]]:
    rows = spark.read.parquet(f"{path}/bounds").orderBy("place").collect()
    return rows[0]["key"], [r["bound"] for r in rows[1:]], [f["name"] for f in json.loads(rows[0]["columns"])["fields"]]


def _scan(spark: SparkSession, path: str) -> DataFrame:
    described = spark.read.parquet(f"{path}/bounds").where("place = 0").first()
    schema = StructType.fromJson(json.loads(described["columns"])).add(PART, IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/rows")


def read_keyed(spark: SparkSession, path: str, ranges: Sequence[int] | None = None) -> DataFrame:
    """The rows of a keyed table, or of some of its key ranges only."""
    rows = _scan(spark, path)
    if ranges is not None:
        rows = rows.where(F.col(PART).isin([int(r) for r in ranges]))
    return rows.drop(PART)


def update_keyed(updates: DataFrame, path: str, columns: Sequence[str], only_null: bool = False,
                 folder: str | None = None, resume: bool = False) -> KeyedUpdate:
    """Set ``columns`` of the keyed table at ``path`` where ``updates`` has its key.

    ``updates`` holds one row per key (see ``last_update``); keys that the table
    lacks are counted and change nothing. Updates are written under ``folder``
    first, so they are computed once. Only ranges that hold a key of theirs are
    joined, and their new rows are complete under ``folder`` before the first
    file is replaced: a run that broke off while replacing goes on with the
    same ``folder`` and ``resume`` from those rows. Plans made before the
    update must not be run after it, as for any table changed in place.
    """
    spark = updates.sparkSession
    key, bounds, names = _described(spark, path)
    unknown = sorted({key, *columns} - set(names)) or sorted({key, *columns} - set(updates.columns))
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}")
    given, folder = folder, folder or run_folder(spark)
    if given:
        open_run(spark, folder, resume, {"job": "update_keyed", "path": path, "columns": list(columns),
                                         "only_null": only_null, "updates": fingerprint(updates.select(key, *columns))})
    in_range = range_of(F.col(key), bounds)
    placed = materialize(
        lambda: updates.where(F.col(key).isNotNull()).select(key, *columns, in_range.alias(PART)), "updates", folder, resume)

    def changed() -> DataFrame:
        if not placed.groupBy(key).count().where("count > 1").isEmpty():
            raise ValueError(f"updates repeat a {key}; reduce them with last_update")
        # Of every touched range only the keys are read, to leave out those that hold none of them.
        touched = [r[0] for r in placed.select(PART).distinct().collect()]  # at most as many as there are ranges
        held = _scan(spark, path).where(F.col(PART).isin(touched)).select(PART, key)
        met = held.join(placed.select(key), key, "left_semi").groupBy(PART).agg(F.count("*").alias("rows"))
        return met

    met = {r[PART]: r["rows"] for r in materialize(changed, "met", folder, resume).collect()}
    rewritten = sorted(met)
    if rewritten:
        old = _scan(spark, path).where(F.col(PART).isin(rewritten))
        new = materialize(lambda: apply_updates(old, placed.drop(PART), key, columns, only_null), "new-rows", folder, resume)
        new.hint("rebalance", PART).write.partitionBy(PART).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(f"{path}/rows")
    return KeyedUpdate(placed.count(), sum(met.values()), rewritten, len(bounds) + 1)
