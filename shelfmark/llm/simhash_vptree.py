"""Near-duplicates by SimHash, found with vantage-point trees over Hamming distance.

Fingerprints of 64 bits link at ``max_distance`` differing bits or fewer. A
vantage-point tree cuts the fingerprints into shards: each node has a vantage
point and a radius, and by the triangle inequality a search around ``x`` can
leave out one side of a node unless ``x`` lies within the search distance of
the radius. Over all 64 bits that bound prunes little, as random fingerprints
lie between 28 and 36 bits from any vantage point. So there is a tree for each
of the four 16-bit quarters: of two fingerprints that differ in at most 4 bits
at least one quarter differs in at most one bit, and the trees search for that
with distance 1. A quarter whose points are all alike is cut on by distance
over all bits. Candidates are compared over all 64 bits, so the links are exact.

Every fingerprint goes to its home shard and visits the shards of higher number
that its search ball overlaps. Within a shard only a spanning forest of the
links is given out, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import plain_names, stored, without_rows
from shelfmark.llm.components import connected_components

QUARTERS = 4
ALL_BITS = 0xFFFFFFFFFFFFFFFF
_BLOCK = 65536


def fingerprint(text: str | None, shingle_words: int = 4, seed: int = 42) -> int:
    """SimHash of a text as an unsigned integer.

    A-Z is lower-cased, words are runs without ASCII white space, shingles are
    space-joined and counted with repeats; a text with fewer words is one
    shingle, a text without words (or null) has fingerprint zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    width = min(shingle_words, len(words))
    votes, total = np.zeros(64, dtype=np.int64), len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    for first in range(0, total, _BLOCK):
        last = min(first + _BLOCK, total)
        hashes = np.array([digest(joined[starts[i]:ends[i + width - 1] - 1], seed) for i in range(first, last)],
                          dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((votes * 2 > total).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        compute, "doc_id bigint, fp bigint")


# --- trees ------------------------------------------------------------------

class VantageTree:
    """Tree over masked Hamming distance: ``nodes`` are (mask, reach, vantage, radius, inner, outer).

    ``inner`` and ``outer`` are node numbers, or ``-1 - shard``. Points at most
    ``radius`` away are inside. ``reach`` is the search distance under ``mask``.
    """

    def __init__(self, sample: np.ndarray, quarter: int, leaves: int, max_distance: int):
        self.nodes: list[list[int]] = []
        self.shards = 0
        self._near = 0xFFFF << (16 * quarter), max_distance // QUARTERS
        self._far = ALL_BITS, max_distance
        self._random = np.random.default_rng(quarter)
        self.root = self._grow(sample, max(0, (leaves - 1).bit_length()))

    def _grow(self, points: np.ndarray, depth: int) -> int:
        if depth and len(points) > 1:
            for mask, reach in (self._near, self._far):
                vantage = int(points[self._random.integers(len(points))])
                distance = np.bitwise_count((points ^ np.uint64(vantage)) & np.uint64(mask))
                radius = self._radius(distance)
                if radius is not None:
                    node = len(self.nodes)
                    self.nodes.append([mask, reach, vantage, radius, 0, 0])
                    inside = distance <= radius
                    self.nodes[node][4] = self._grow(points[inside], depth - 1)
                    self.nodes[node][5] = self._grow(points[~inside], depth - 1)
                    return node
        self.shards += 1
        return -self.shards

    @staticmethod
    def _radius(distance: np.ndarray) -> int | None:
        """The radius that cuts most evenly, if any leaves points on both sides."""
        counts = np.bincount(distance).cumsum()
        usable = np.flatnonzero(counts < counts[-1])
        usable = usable[counts[usable] > 0]
        return int(usable[np.argmin(np.abs(counts[usable] * 2 - counts[-1]))]) if len(usable) else None

    def visits(self, points: np.ndarray, search: bool) -> list[tuple[int, np.ndarray]]:
        """Shards with the indexes of the points that lie there, or with ``search`` of those whose ball overlaps it."""
        found, stack = [], [(self.root, np.arange(len(points)))]
        while stack:
            node, index = stack.pop()
            if not len(index):
                continue
            if node < 0:
                found.append((-1 - node, index))
                continue
            mask, reach, vantage, radius, inner, outer = self.nodes[node]
            distance = np.bitwise_count((points[index] ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)
            slack = reach if search else 0
            stack += [(inner, index[distance - slack <= radius]), (outer, index[distance + slack > radius])]
        return found


def plant(distinct: DataFrame, shards: int, sample_rows: int, max_distance: int) -> list[VantageTree]:
    """A tree for each quarter, fitted on at most ``sample_rows`` fingerprints chosen by hash."""
    rows = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).collect()
    sample = np.array([r.fp for r in rows], dtype=np.int64).view(np.uint64)
    return [VantageTree(sample, quarter, shards, max_distance) for quarter in range(QUARTERS)]


# --- links ------------------------------------------------------------------

def _earlier_quarter(diff: np.ndarray, quarter: int, reach: int) -> np.ndarray:
    """Whether a quarter before this one is within reach: that tree gives the link."""
    earlier = np.zeros(diff.shape, dtype=bool)
    for q in range(quarter):
        earlier |= np.bitwise_count(diff & np.uint64(0xFFFF << (16 * q))) <= reach
    return earlier


def _forest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every node to the smallest of its local component."""
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def links_in_cell(targets: np.ndarray, queries: np.ndarray, quarter: int, max_distance: int,
                  pairs: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between ``queries`` and ``targets`` (both unsigned) within ``max_distance`` bits.

    The comparison runs in blocks of about ``pairs`` pairs. Of a query's hits the
    first is linked to it and the others to that first one, so a dense group
    leaves few different links.
    """
    nodes, place = np.unique(np.concatenate([targets, queries]), return_inverse=True)
    at_target, at_query = place[:len(targets)], place[len(targets):]
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, pairs // max(1, len(targets)))
    for first in range(0, len(queries), step):
        diff = queries[first:first + step, None] ^ targets[None, :]
        query, target = np.nonzero(np.bitwise_count(diff) <= max_distance)
        if not len(query):
            continue
        fresh = (diff[query, target] != 0) & ~_earlier_quarter(diff[query, target], quarter, max_distance // QUARTERS)
        query, target = query[fresh], target[fresh]
        heads, where, group = np.unique(query, return_index=True, return_inverse=True)
        lead = at_target[target[where]]
        codes = np.unique(np.concatenate([
            at_query[first + heads] * len(nodes) + lead, at_target[target] * len(nodes) + lead[group]]))
        lefts.append(codes // len(nodes))
        rights.append(codes % len(nodes))
    return _forest(nodes, np.concatenate(lefts), np.concatenate(rights))


def fingerprint_links(distinct: DataFrame, max_distance: int = 4, shard_rows: int = 4096, least_shards: int = 256,
                      most_shards: int = 4096, sample_rows: int = 50_000, cell_rows: int = 16_384) -> DataFrame:
    """Links ``a, b`` between the fingerprints of ``distinct(fp)`` that keep all connections within ``max_distance``.

    A shard with more than ``cell_rows`` rows is dealt to a grid of cells of
    that size, so a task holds a bounded number whatever the data are.
    """
    if max_distance >= 2 * QUARTERS:
        raise ValueError("four quarters serve distances below 8")
    count = distinct.count()
    shards = min(most_shards, max(least_shards, -(-count // shard_rows)))
    trees = plant(distinct, shards, sample_rows, max_distance)
    numbered = np.cumsum([0, *(t.shards for t in trees)])

    def deal(points: np.ndarray) -> Iterator[tuple[int, np.ndarray, bool]]:
        for tree, offset in zip(trees, numbered):
            home = np.zeros(len(points), dtype=np.int64)
            for shard, index in tree.visits(points, False):
                home[index] = shard
                yield int(offset) + shard, index, True
            for shard, index in tree.visits(points, True):
                # A pair needs one meeting: the point with the lower home visits.
                yield int(offset) + shard, index[home[index] < shard], False

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, index, home in deal(points):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(index), shard, np.int32)), pa.array(points[index].view(np.int64)),
                    pa.array(np.full(len(index), home))], names=["shard", "fp", "home"])

    visits = stored(distinct.select("fp").mapInArrow(visit, "shard int, fp bigint, home boolean"), "visits")
    # One count per shard, at most QUARTERS * most_shards rows.
    large = {r.shard: -(-r.n // cell_rows) for r in visits.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows).collect()}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of a shard: its home rows in row ``i`` and, as those who search, everything in column ``j``."""
        for batch in batches:
            shard, fp, home = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for cells in np.unique([large.get(s, 1) for s in np.unique(shard)]):
                here = np.isin(shard, [s for s in np.unique(shard) if large.get(s, 1) == cells])
                s, f, h = shard[here], fp[here], home[here]
                mixed = f.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                part = ((mixed >> np.uint64(32)) % np.uint64(cells)).astype(np.int32)
                for other in range(int(cells)):
                    yield _cell(s, f, part * 0 + other, part, False)
                    yield _cell(s[h], f[h], part[h], part[h] * 0 + other, True)

    def _cell(shard, fp, i, j, target) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(shard), pa.array(i), pa.array(j), pa.array(fp), pa.array(np.full(len(fp), target))],
            names=["shard", "i", "j", "fp", "target"])

    quarters = [q for q, t in enumerate(trees) for _ in range(t.shards)]

    def compare(key, cell: pd.DataFrame) -> pd.DataFrame:
        fp, target = cell["fp"].to_numpy().view(np.uint64), cell["target"].to_numpy()
        a, b = links_in_cell(fp[target], fp[~target], quarters[key[0]], max_distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    cells = visits.mapInArrow(spread, "shard int, i int, j int, fp bigint, target boolean")
    return cells.groupBy("shard", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, shingle_words: int = 4, max_distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    ``component_id`` is the smallest ``doc_id`` that links of at most
    ``max_distance`` bits lead to, itself included. Null and empty texts have
    fingerprint zero and are linked like any other. A null id is no candidate
    for ``component_id`` (null if a component has no other). Repeated rows are
    all returned. Extra columns are ignored; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(fingerprint_links(distinct, max_distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle_words: int = 4, max_distance: int = 4) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id (of repeated ids one row).

    Rows with a null id cannot be told apart and stay, null and empty texts are
    near copies of each other. Extra columns stay, whatever their names; an
    empty table gives no rows. Texts that stay are not shuffled.
    """
    groups = simhash_groups(docs.select("doc_id", "text"), shingle_words, max_distance).where("doc_id IS NOT NULL")
    verdicts = groups.groupBy(F.col("doc_id").alias("id")).agg(
        F.min(F.col("doc_id") == F.col("component_id")).alias("kept"), F.count(F.lit(1)).alias("copies"))
    rows, back, new = plain_names(docs)
    marked = rows.withColumn("id", F.col(new["doc_id"]).cast("bigint"))
    return without_rows(marked, ["id"], stored(verdicts, "simhash-verdicts")).select(*back)
