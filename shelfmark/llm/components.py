"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; ``root`` is the smallest node of its component.

    Each round replaces the links of a node by links to the smallest node it
    can see, so the depth of a component about halves. Rounds are written to
    the shared folder; only two counters come back to the driver. Self-links
    and repeated links do no harm; without edges the result is empty.
    """
    a, b = F.col("a"), F.col("b")
    links = stored(
        edges.where(a != b).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.unionAll(links.select(b.alias("a"), a.alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(lowest, "a").where(b > a).select(b.alias("a"), F.col("low").alias("b")).distinct()
        large = stored(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").where(b != F.col("low")).select(b.alias("a"), F.col("low").alias("b"))
        links = stored(small.unionAll(lowest.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        # Done when every node has one link and no link leads to a node that has one itself.
        leaves = links.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if links.join(leaves.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() and \
                leaves.where("n > 1").isEmpty():
            break
    return links.select(a.alias("node"), b.alias("root")).unionAll(
        links.select(b.alias("node"), b.alias("root")).distinct())
