"""Fixity audit of WARC archives with Merkle trees.

Pages become WARC response records; records of an archive follow one another in
id order and have an offset range. A leaf is the digest of a record with its
range, a node the digest of up to ``fanout`` children with the range they span.
Two replicas are compared by the roots of their archives; below equal roots
nothing is read, and each level joins only the children of nodes that differ.
Records are matched only where leaves differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

_NAMELESS = 1 << 16


def warc_record(url: Column, html: Column, page_id: Column) -> Column:
    """A WARC/1.1 record as text; null url and content count as empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def archive_records(pages: DataFrame, archive_pages: int = 512) -> DataFrame:
    """archive, page_id, record of every page: an archive holds a range of ``archive_pages`` ids.

    Pages without an id are known by their content only and are dealt by it to
    archives below zero, so that many of them do not make one archive. Ids are
    not negative.
    """
    nameless = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(_NAMELESS))
    return pages.select(
        F.coalesce(F.floor(F.col("page_id") / archive_pages), nameless).cast("bigint").alias("archive"),
        F.col("page_id").cast("bigint").alias("page_id"),
        warc_record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"))


def _digests(records: DataFrame) -> DataFrame:
    """archive, page_id, nth, sha256, bytes: ``nth`` counts records that repeat an id, in order of their digests."""
    narrow = records.select("archive", "page_id", F.sha2(F.col("record").cast("binary"), 256).alias("sha256"),
                            F.octet_length("record").cast("bigint").alias("bytes"))
    repeats = Window.partitionBy("archive", "page_id").orderBy("sha256")
    return narrow.withColumn("nth", F.row_number().over(repeats))


def fixity_leaves(records: DataFrame) -> DataFrame:
    """The manifest: archive, place (from 0), page_id, nth, begin, stop, sha256 of every record in id order.

    Only digests and lengths are shuffled.
    """
    order = Window.partitionBy("archive").orderBy("page_id", "nth")
    running = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _digests(records).select(
        "archive", (F.row_number().over(order) - 1).cast("bigint").alias("place"), "page_id", "nth",
        (running - F.col("bytes")).alias("begin"), running.alias("stop"), "sha256")


def merkle_levels(leaves: DataFrame, fanout: int = 16) -> list[DataFrame]:
    """Node tables from the leaves up to the roots: archive, place, begin, stop, digest.

    Every level has a ``fanout``-th of the rows below it; they end when every
    archive has one node.
    """
    own = F.concat_ws(":", "sha256", F.col("begin").cast("string"), F.col("stop").cast("string"))
    levels = [stored(leaves.select("archive", "place", "begin", "stop", F.sha2(own, 256).alias("digest")), "merkle")]
    while not levels[-1].where(F.col("place") > 0).isEmpty():
        below = levels[-1]
        children = F.array_sort(F.collect_list(F.struct("place", "digest")))
        # A node has at most ``fanout`` children, so its list is short.
        nodes = below.groupBy("archive", F.floor(F.col("place") / fanout).alias("place")).agg(
            F.min("begin").alias("begin"), F.max("stop").alias("stop"), children.alias("children"))
        text = F.concat_ws(":", F.array_join(F.col("children.digest"), ""), F.col("begin").cast("string"),
                           F.col("stop").cast("string"))
        levels.append(stored(nodes.select("archive", "place", "begin", "stop", F.sha2(text, 256).alias("digest")), "merkle"))
    return levels


def audit(primary: list[DataFrame], replica: list[DataFrame], fanout: int = 16) -> DataFrame:
    """archive, place of the leaves that differ between two trees, found from the roots down.

    Trees of different heights are compared from the higher one's top; a
    missing node differs. Equal trees give no rows, two empty ones too.
    """
    height = max(len(primary), len(replica))
    empty = primary[0].limit(0)
    suspects = None
    for level in range(height - 1, -1, -1):
        here, there = (t[level] if level < len(t) else empty for t in (primary, replica))
        here, there = here.select("archive", "place", "digest"), there.select("archive", "place", F.col("digest").alias("other"))
        if suspects is not None:
            parent = F.floor(F.col("place") / fanout).alias("parent")
            above = suspects.select("archive", F.col("place").alias("parent"))
            here = here.withColumn("parent", parent).join(above, ["archive", "parent"], "left_semi").drop("parent")
            there = there.withColumn("parent", parent).join(above, ["archive", "parent"], "left_semi").drop("parent")
        met = here.join(there, ["archive", "place"], "full")
        suspects = stored(met.where(~F.col("digest").eqNullSafe(F.col("other"))).select("archive", "place"), "suspects")
        if suspects.isEmpty():
            return suspects
    return suspects


def fixity_audit(primary: DataFrame, replica: DataFrame, fanout: int = 16) -> DataFrame:
    """One row for every record of either replica, both ``(archive, page_id, record)``.

    archive, place, page_id, begin, stop and sha256 as in the primary, ``root``
    of the archive's tree, and ``status``: ``intact``, ``altered`` (another
    digest), ``missing`` (in the primary only) or ``extra`` (in the replica
    only: place, begin, stop and root are null, sha256 is the replica's). A
    lost or longer record moves those behind it in its archive; their leaves
    differ, and matching them by id and digest finds them intact. An
    altered record without id is ``missing`` and ``extra``. Repeated rows are
    records of their own, empty tables give no rows.
    """
    own, other = (stored(fixity_leaves(r), "manifest") for r in (primary, replica))
    tree = merkle_levels(own, fanout)
    suspects = audit(tree, merkle_levels(other, fanout), fanout)
    roots = tree[-1].select("archive", F.col("digest").alias("root"))

    def suspected(leaves: DataFrame) -> DataFrame:
        return leaves.join(suspects, ["archive", "place"], "left_semi")

    here, there = suspected(own), suspected(other).select(
        F.col("archive").alias("a"), F.col("page_id").alias("p"), F.col("nth").alias("n"), F.col("sha256").alias("s"))
    same = (here["archive"] == there["a"]) & here["page_id"].eqNullSafe(there["p"]) & (here["nth"] == there["n"])
    status = F.when(F.col("a").isNull(), "missing").when(F.col("place").isNull(), "extra").when(
        F.col("sha256") != F.col("s"), "altered")
    judged = here.join(there, same, "full").withColumn("status", status).where("status IS NOT NULL")
    judged = stored(judged, "damage")
    damaged = judged.where("status <> 'extra'").select("archive", "place", "status")
    rows = own.join(damaged, ["archive", "place"], "left").join(roots, "archive").select(
        "archive", "place", "page_id", "begin", "stop", "sha256",
        F.coalesce("status", F.lit("intact")).alias("status"), "root")
    extra = judged.where("status = 'extra'").select(
        F.col("a").alias("archive"), F.col("p").alias("page_id"), F.col("s").alias("sha256"), "status")
    return rows.unionByName(extra, allowMissingColumns=True)
