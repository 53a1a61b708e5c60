"""Which metadata a hit on a corpus document shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed
from shelfmark.functions import text as tx


def resolve_metadata(corpus: DataFrame, lookup: DataFrame | None = None, key: str = "code",
                     fields: Sequence[str] = fixed.LOOKUP_FIELDS) -> DataFrame:
    """Corpus with ``fields`` replaced by what a search hit on the row shows.

    ``key="code"``: a document with a whole-number id shows the lookup entry
    of that number (the last document wins); other ids show their own fields.
    ``key="position"``: every document shows its own fields.

    Resolved once per document here, hits need no join of their own. The
    lookup has one row per key; where a code repeats very often the long side
    of the join is split by the adaptive skew handling.
    """
    kept = ["position", "id", "embedding"]
    if key == "position":
        return corpus.select(*kept, *fields)
    if key != "code":
        raise ValueError("key is 'code' or 'position'")
    entries = lookup.select(F.col("key").alias("__key"), F.struct(*fields).alias("__entry"))
    joined = corpus.withColumn("__key", tx.lookup_key(F.col("id"))).join(entries, "__key", "left")
    whole = tx.is_whole_number(F.col("id"))
    return joined.select(
        *kept, *[F.when(whole, F.col(f"__entry.{f}")).otherwise(F.col(f)).alias(f) for f in fields]
    )
