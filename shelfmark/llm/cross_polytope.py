"""Approximate nearest neighbours by cross-polytope hashing.

A table of the index is a fast pseudo-rotation (three rounds of random signs
and a Hadamard transform) and its bucket of a vector is the signed axis next to
the rotated vector. A query looks into several buckets of every table, those
whose axes are nearest to it (multiprobe). Rows and queries of a bucket meet in
one task, in cells of bounded size, where exact cosines are computed; each cell
gives a query's best few, so no pair of vectors is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row (a power of two long), scaled to keep lengths."""
    x, width, step = x.copy(), x.shape[1], 1
    while step < width:
        y = x.reshape(len(x), width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), width)
        step *= 2
    return x / np.sqrt(width)


class CrossPolytope:
    """``tables`` pseudo-rotations of vectors of ``dimensions``; buckets are 0 to 2 * width - 1 in each."""

    def __init__(self, dimensions: int, tables: int, seed: int):
        self.width = 1 << max(0, (dimensions - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, self.width))

    def rotated(self, vectors: np.ndarray, table: int) -> np.ndarray:
        x = np.zeros((len(vectors), self.width))
        x[:, :vectors.shape[1]] = vectors
        for signs in self.signs[table]:
            x = hadamard(x * signs)
        return x

    def buckets(self, vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` nearest signed axes of every vector, nearest first."""
        x = self.rotated(vectors, table)
        signed = np.concatenate([x, -x], axis=1)
        near = np.argpartition(-signed, probes - 1, axis=1)[:, :probes] if probes < signed.shape[1] else \
            np.broadcast_to(np.arange(signed.shape[1]), signed.shape)
        order = np.argsort(-np.take_along_axis(signed, near, 1), axis=1, kind="stable")
        return np.take_along_axis(near, order, 1)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite numbers."""
    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))

    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    if pc.any(pc.not_equal(pc.list_value_length(column), size)).as_py():
        raise ValueError(f"a vector does not have {size} components")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """id, vector: of equal vectors only the ``keep`` smallest ids, as no search can return more.

    The ranking window limits each task's rows before the shuffle, so a vector
    that a third of all rows share costs ``keep`` rows a task.
    """
    same = Window.partitionBy("vector").orderBy("id")
    return vectors.withColumn("place", F.row_number().over(same)).where(F.col("place") <= keep).drop("place")


def search(rows: DataFrame, queries: DataFrame, k: int = 5, tables: int = 10, probes: int = 12, seed: int = 7,
           cell_rows: int = 8192) -> DataFrame:
    """The ``k`` nearest of ``rows(id, vector)`` found for every one of ``queries(id, vector)``, by cosine.

    query_id, rank (from 1), id, score; a query's own id is no candidate. Ties
    go to the smaller id. Rows with a null id and vectors that are null, zero,
    or hold null, NaN or infinite components take no part; a vector of another
    size than the others is an error. Repeated ids are separate rows that tie
    and count once. A query that finds fewer than ``k`` in its buckets is
    compared with all rows, in cells as well. Empty tables give no rows.
    """
    vector = F.col("vector").cast("array<double>")

    def prepared(table: DataFrame) -> DataFrame:
        return table.where(F.col("id").isNotNull() & usable(F.col("vector"))).select(
            F.col("id").cast("bigint").alias("id"), vector.alias("vector"))

    rows = stored(distinct_vectors(prepared(rows).distinct(), k + 1), "vectors")
    queries = stored(prepared(queries).distinct(), "query-vectors")
    one = rows.select(F.size("vector").alias("n")).first()
    size = one.n if one else 1
    index = CrossPolytope(size, tables, seed)
    probes = min(probes, 2 * index.width)
    schema = "table int, bucket int, target boolean, id bigint, vector array<double>"

    def hashed(count: int, target: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = _matrix(batch.column(1), size)
                for table in range(tables):
                    buckets = index.buckets(vectors, table, count)
                    for probe in range(count):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(vectors), table, np.int32)),
                            pa.array(buckets[:, probe].astype(np.int32)),
                            pa.array(np.full(len(vectors), target)), *batch.columns],
                            names=["table", "bucket", "target", "id", "vector"])

        return run

    met = _meet(rows.mapInArrow(hashed(1, True), schema), queries.mapInArrow(hashed(probes, False), schema),
                k, cell_rows, size)
    found = stored(_nearest(met, k), "nearest")
    enough = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = queries.join(enough, "id", "left_anti")
    if short.isEmpty():
        return found

    def everywhere(table: DataFrame, target: bool) -> DataFrame:
        return table.select(F.lit(-1).alias("table"), F.lit(0).alias("bucket"), F.lit(target).alias("target"),
                            "id", "vector")

    whole = _nearest(_meet(everywhere(rows, True), everywhere(short, False), k, cell_rows, size), k)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(whole)


def _nearest(met: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    pairs = met.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = pairs.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def _meet(targets: DataFrame, queries: DataFrame, k: int, cell_rows: int, size: int) -> DataFrame:
    """Best ``k`` of each cell: targets and queries of a bucket, each dealt to chunks of about ``cell_rows``."""

    def chunks(table: DataFrame, name: str) -> DataFrame:
        # One count for each bucket, whatever the number of rows.
        counts = table.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n"))
        return stored(counts.select("table", "bucket", F.ceil(F.col("n") / cell_rows).cast("int").alias(name)), name)

    sizes = F.broadcast(chunks(targets, "chunks").join(chunks(queries, "slices"), ["table", "bucket"]))
    own = F.xxhash64("id", "vector")
    chunk, slices = F.pmod(own, F.col("chunks")).cast("int"), F.sequence(F.lit(0), F.col("slices") - 1)
    slice_, chunk_list = F.pmod(own, F.col("slices")).cast("int"), F.sequence(F.lit(0), F.col("chunks") - 1)
    columns = ["table", "bucket", "target", "id", "vector"]
    cells = targets.join(sizes, ["table", "bucket"]).select(
        *columns, chunk.alias("chunk"), F.explode(slices).alias("slice")).unionByName(
        queries.join(sizes, ["table", "bucket"]).select(
            *columns, F.explode(chunk_list).alias("chunk"), slice_.alias("slice")))

    def compare(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
        target, ids = cell["target"].to_numpy(), cell["id"].to_numpy()
        if len({len(v) for v in cell["vector"]} | {size}) > 1:
            raise ValueError(f"a vector does not have {size} components")
        vectors = np.array(cell["vector"].tolist(), dtype=float)
        return _best(ids[target], vectors[target], ids[~target], vectors[~target], k)

    return cells.groupBy("table", "bucket", "chunk", "slice").applyInPandas(
        compare, "query_id bigint, id bigint, score double")


def _best(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, query_vectors: np.ndarray,
          k: int) -> pd.DataFrame:
    found: list[tuple[int, int, float]] = []
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None] if len(vectors) else vectors
    for first in range(0, len(query_ids) if len(ids) else 0, 256):
        q = query_vectors[first:first + 256]
        scores = (q / np.linalg.norm(q, axis=1)[:, None]) @ unit.T
        for i, own in enumerate(scores):
            near = np.flatnonzero(ids != query_ids[first + i])
            if len(near) > k:  # rounding may reorder near ties, so all within it of the k-th are scored exactly
                near = near[own[near] >= np.partition(own[near], -k)[-k] - 1e-12]
            exact = sorted((-_cosine(q[i], vectors[c]), ids[c]) for c in near)
            found += [(query_ids[first + i], c, -s) for s, c in exact[:k]]
    table = pd.DataFrame(found, columns=["query_id", "id", "score"])
    return table.astype({"query_id": "int64", "id": "int64", "score": "float64"})


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))))
