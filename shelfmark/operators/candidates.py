"""Hits to lettered candidates.

The hits of a query are one short array (at most k), already in score order,
so grouping, ranking and labelling stay inside the row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx


def with_candidates(df: DataFrame, hits: str = "hits", out: str = "candidates") -> DataFrame:
    """Replace ``hits`` by the array of candidates.

    Hits that share the first four path elements are one candidate, with the
    best score among them and the attributes (levels 5 and up, one per code) in
    hit order. Candidates are ordered by score, ties by first hit. Hits
    without path are ignored. A row without usable hits gets an empty array.
    """
    present = F.coalesce(F.col(hits), F.array().cast(df.schema[hits].dataType))
    return df.withColumn(out, candidate_array(present)).drop(hits)


def candidate_array(hits: Column) -> Column:
    """Candidates of one array of hits.

    ``let`` gives a name to each intermediate array. A lambda that referred to
    an outer column instead would compute that column again for every element
    once Catalyst merges the projections.
    """
    usable = F.filter(F.transform(hits, _keyed), lambda h: h["key"] != "")

    def build(found: Column) -> Column:
        # First appearance in score order is also the order of best scores.
        keys = F.array_distinct(F.transform(found, lambda h: h["key"]))
        groups = F.transform(keys, lambda key: F.filter(found, lambda h: h["key"] == key))
        return F.transform(groups, _candidate)

    return tx.let(usable, build)


def _keyed(hit: Column) -> Column:
    return tx.let(
        path_prefix(hit["hierarchy_path"]),
        lambda path: F.struct(
            hit["score"].alias("score"),
            F.coalesce(hit["level"], F.lit(0)).alias("level"),
            hit["code"].alias("code"),
            hit["title"].alias("title"),
            path.alias("path"),
            F.coalesce(F.array_join(path, fixed.PATH_JOINER), F.lit("")).alias("key"),
        ),
    )


def _candidate(group: Column, index: Column) -> Column:
    first = F.get(group, F.lit(0))
    return F.struct(
        tx.option_letter(index).alias("letter"),
        first["path"].alias("hierarchy_path"),
        first["key"].alias("hierarchy_string"),
        first["score"].alias("score"),
        _attributes(group).alias("attributes"),
    )


def path_prefix(path: Column) -> Column:
    """Path elements that identify a candidate."""
    return F.slice(path, 1, fixed.BRICK_DEPTH)


def _attributes(group: Column) -> Column:
    deep = F.filter(group, lambda h: h["level"] > fixed.BRICK_DEPTH)
    listed = F.transform(
        deep, lambda h: F.struct(h["level"].alias("level"), h["code"].alias("code"), h["title"].alias("title"))
    )
    return F.aggregate(
        listed,
        F.array().cast("array<struct<level:int,code:string,title:string>>"),
        lambda kept, a: F.when(F.exists(kept, lambda b: b["code"].eqNullSafe(a["code"])), kept).otherwise(
            F.concat(kept, F.array(a))
        ),
    )


def level_columns(candidate: Column, targets: list[str] = fixed.TARGET_COLUMNS) -> list[Column]:
    """The target columns of a chosen candidate.

    Path elements first; the fifth column is the first level-5 attribute title,
    the sixth the first level-6 title; '' where there is none.
    """

    def title_at(level: int) -> Column:
        return F.get(F.filter(candidate["attributes"], lambda a: a["level"] == level), F.lit(0))["title"]

    columns = []
    for i, name in enumerate(targets):
        value = F.get(candidate["hierarchy_path"], F.lit(i))
        if i in (fixed.BRICK_DEPTH, fixed.BRICK_DEPTH + 1):
            value = F.coalesce(value, title_at(i + 1))
        columns.append(F.coalesce(value, F.lit("")).alias(name))
    return columns


def candidate_rows(df: DataFrame, key: str, candidates: str = "candidates") -> DataFrame:
    """One row per candidate with its rank from 1."""
    # The plain posexplode would add a filter that builds the array once more.
    exploded = df.select(key, F.posexplode_outer(candidates).alias("place", "candidate"))
    return exploded.where(F.col("place").isNotNull()).select(key, (F.col("place") + 1).alias("rank"), "candidate.*")
