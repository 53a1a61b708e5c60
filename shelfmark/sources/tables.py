"""Relational tables: scans, parameterised SQL, pending rows, keyed updates."""

from __future__ import annotations

import re
from collections.abc import Sequence
from decimal import Decimal
from itertools import pairwise
from operator import itemgetter
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a Parquet path or a catalog table with an explicit column list."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str, fetch_rows: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options; user, password, driver and authentication go in ``extra``."""
    return {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **extra}


def read_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str], key: str,
              bounds: tuple[Any, Any], partitions: int, **extra: str) -> DataFrame:
    """Partitioned JDBC scan: ``partitions`` ranges of ``key`` read in parallel.

    Rows outside ``bounds`` fall into the first and the last range, none is
    lost. Column list and NULL filters are pushed to the database.
    """
    low, high = bounds
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, table, **extra))
        .option("partitionColumn", key)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(partitions))
        .load()
        .select(*columns)
    )


def range_starts_query(table: str, key: str, partitions: int) -> str:
    """Statement for the smallest key of each of ``partitions`` ranges that hold equally many rows."""
    dealt = f"SELECT {key} AS k, NTILE({partitions}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL"
    return f"SELECT part, MIN(k) AS low FROM ({dealt}) AS dealt GROUP BY part"


def _literal(value: Any) -> str:
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_conditions(key: str, starts: Sequence[Any]) -> list[str]:
    """One condition for each range that begins at one of ``starts``, given in the database's order.

    Every row meets exactly one: the first takes all smaller and NULL keys, the
    last all greater ones. A key that fills several ranges begins one only.
    """
    cuts = [_literal(b) for a, b in pairwise(starts) if a != b]
    if not cuts:
        return ["1 = 1"]
    between = [f"{key} >= {a} AND {key} < {b}" for a, b in pairwise(cuts)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *between, f"{key} >= {cuts[-1]}"]


def read_jdbc_evenly(spark: SparkSession, url: str, table: str, columns: Sequence[str], key: str,
                     partitions: int, **extra: str) -> DataFrame:
    """JDBC scan in ranges of ``key`` with equally many rows, however the keys are spread.

    :func:`read_jdbc` cuts its bounds into equal widths, so keys with gaps or
    clusters leave some tasks empty and others with most of the table. Here the
    database ranks the keys once and gives ``partitions`` starts. All rows of
    one key are in one range.
    """
    options = jdbc_options(url, table, **extra)
    query = {**{k: v for k, v in options.items() if k != "dbtable"}, "query": range_starts_query(table, key, partitions)}
    starts = [(r[0], r[1]) for r in spark.read.format("jdbc").options(**query).load().collect()]  # ``partitions`` rows
    conditions = range_conditions(key, [low for _, low in sorted(starts, key=itemgetter(0))])
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=conditions, properties=properties).select(*columns)


def run_sql(spark: SparkSession, query: str, params: dict[str, Any] | None = None,
            **tables: DataFrame) -> DataFrame:
    """SQL with named binds (``:name``) and DataFrames (``{name}``)."""
    return spark.sql(query, args=params or {}, **tables)


def pending_rows(table: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``target`` is still NULL, with only ``columns``."""
    return table.where(F.col(target).isNull()).select(*columns)


def pending_count(table: DataFrame, target: str) -> DataFrame:
    """Number of rows whose ``target`` is still NULL, as one row."""
    return table.where(F.col(target).isNull()).agg(F.count("*").alias("remaining"))


def page_of_rows(df: DataFrame, key: str, offset: int, size: int) -> DataFrame:
    """Preview page in key order. The jobs do not page, they scan once."""
    return df.orderBy(key).offset(offset).limit(size)


def last_update(updates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the update that comes last in ``order``.

    An aggregate, so a key with very many updates is reduced before the shuffle.
    """
    columns = [c for c in updates.columns if c != key]
    rank = F.struct(*[F.col(c) for c in order])
    latest = F.max_by(F.struct(*[F.col(c) for c in columns]), rank)
    return updates.groupBy(key).agg(latest.alias("last")).select(key, "last.*")


def apply_updates(table: DataFrame, updates: DataFrame, key: str,
                  columns: Sequence[str], only_null: bool = False) -> DataFrame:
    """Table with ``columns`` replaced where ``updates`` has the key.

    ``updates`` holds one row per key (see :func:`last_update`). Keys that the
    table lacks change nothing. ``only_null`` keeps values already set. A big
    update set makes this a sort-merge join on the key; a small one is
    broadcast by the adaptive planner from its measured size.
    """
    renamed = updates.select(
        F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = table.join(renamed, key, "left")

    def value(name: str):
        if name not in columns:
            return F.col(name)
        hit = F.col("__hit").isNotNull()
        if only_null:
            hit = hit & F.col(name).isNull()
        return F.when(hit, F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[value(c) for c in table.columns])


def apply_pending_updates(table: DataFrame, updates: DataFrame, key: str, columns: Sequence[str],
                          target: str, only_null: bool = False) -> DataFrame:
    """:func:`apply_updates` where only rows with a NULL ``target`` can change.

    Finished rows pass through without a shuffle; only the pending ones meet
    the updates.
    """
    pending = F.col(target).isNull()
    changed = apply_updates(table.where(pending), updates, key, columns, only_null)
    return table.where(~pending).unionByName(changed)


def merge_into_table(updates: DataFrame, table: str, key: str, columns: Sequence[str]) -> None:
    """Update a catalog table in place, for table formats that support MERGE."""
    source = updates.alias("updates")
    source.mergeInto(table, F.col(f"{table}.{key}") == F.col(f"updates.{key}")).whenMatched().update(
        {c: F.col(f"updates.{c}") for c in columns}
    ).merge()


# How a JSON text column becomes a database vector.
VECTOR_CASTS = {
    "sqlserver": "CAST(CAST({column} AS VARCHAR(MAX)) AS VECTOR({dimension}))",
    "postgresql": "CAST({column} AS vector({dimension}))",
}


def merge_statement(table: str, staging: str, key: str, columns: Sequence[str], dimension: int,
                    dialect: str = "sqlserver") -> str:
    """The one statement that moves staged updates into a database table.

    Columns with ``embedding`` in their name are cast to vectors.
    """
    values = {
        c: VECTOR_CASTS[dialect].format(column=f"s.{c}", dimension=dimension) if "embedding" in c.lower() else f"s.{c}"
        for c in columns
    }
    assignments = ", ".join(f"{c} = {value}" for c, value in values.items())
    return f"MERGE INTO {table} AS t USING {staging} AS s ON t.{key} = s.{key} WHEN MATCHED THEN UPDATE SET {assignments};"


def stage_updates(updates: DataFrame, url: str, staging: str, partitions: int, **extra: str) -> None:
    """Write updates to a staging table over ``partitions`` connections.

    Run :func:`merge_statement` in the database afterwards: rows are then set
    by one server-side statement instead of one UPDATE each.
    """
    updates.coalesce(partitions).write.format("jdbc").options(**jdbc_options(url, staging, **extra)).mode(
        "overwrite"
    ).save()


def _within(file: str, folder: str) -> bool:
    """Whether ``file`` lies in ``folder``, by whole path components."""
    parts, inside = ([p for p in re.sub(r"^[a-z0-9]+:", "", x).split("/") if p] for x in (folder, file))
    return inside[:len(parts)] == parts


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a new version of a table; never the path the plan reads from."""
    if any(_within(file, path) for file in df.inputFiles()):
        raise ValueError(f"{path} is read by the same plan; write the snapshot elsewhere")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
