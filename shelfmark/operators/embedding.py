"""Embedding through a pluggable batch provider."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import fixed

# A provider turns a list of texts into one vector per text, in order.
EmbedBatch = Callable[[list[str]], "list[list[float]] | np.ndarray"]


def embed(text: Column, make_provider: Callable[[], EmbedBatch],
          call_rows: int = fixed.EMBED_CALL_ROWS, dimensions: int | None = None) -> Column:
    """Vector of ``text`` as ``array<float>``.

    ``make_provider`` runs once per task, so clients and models are built
    there. Each call gets at most ``call_rows`` texts. Concurrency is the
    number of partitions of the DataFrame. A vector of another size than
    ``dimensions``, or with components that are no finite numbers, is an error
    as soon as the call returns it.
    """

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        provider = make_provider()
        for texts in batches:
            parts = [
                _sized(_as_lists(provider(texts.slice(start, call_rows).to_pylist())), dimensions)
                for start in range(0, len(texts), call_rows)
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

    # Marked so that Catalyst never copies the call into a pushed-down filter.
    return vectors.asNondeterministic()(text)


def _as_lists(vectors) -> pa.Array:
    if isinstance(vectors, np.ndarray):
        rows, width = vectors.shape
        offsets = np.arange(rows + 1, dtype=np.int32) * width
        return pa.ListArray.from_arrays(offsets, pa.array(vectors.astype(np.float32).ravel()))
    return pa.array(vectors, pa.list_(pa.float32()))


def _sized(vectors: pa.Array, dimensions: int | None) -> pa.Array:
    if dimensions is not None and len(vectors):
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        if (sizes != dimensions).any():
            raise ValueError(f"a vector has not {dimensions} components")
        if not np.isfinite(vectors.flatten().to_numpy(zero_copy_only=False)).all():
            raise ValueError("a vector has components that are no finite numbers")
    return vectors


def hashing_provider(dimension: int) -> Callable[[], EmbedBatch]:
    """Offline provider: each token adds +1 or -1 to one component.

    Tokens are split at blanks, tabs and line ends. The first four hex digits
    of a token's md5 choose the component, an even fifth digit means +1. Any
    engine with md5 can reproduce the vectors.
    """

    def make() -> EmbedBatch:
        cells = _TokenCells(dimension)
        tokens = re.compile(r"[^ \t\r\n]+").findall

        def call(texts: list[str]) -> np.ndarray:
            split = [tokens(text or "") for text in texts]
            cell = np.fromiter((cells[token] for row in split for token in row), dtype=np.int64)
            row = np.repeat(np.arange(len(texts)), [len(row) for row in split])
            counts = np.bincount(row * 2 * dimension + cell, minlength=len(texts) * 2 * dimension)
            plus, minus = counts.reshape(len(texts), 2, dimension).swapaxes(0, 1)
            return (plus - minus).astype(np.float32)

        return call

    return make


class _TokenCells(dict):
    """Cell of each token: its component, plus ``dimension`` where it counts -1."""

    LIMIT = 1_000_000

    def __init__(self, dimension: int):
        self.dimension = dimension

    def __missing__(self, token: str) -> int:
        digest = hashlib.md5(token.encode("utf-8")).hexdigest()
        if len(self) >= self.LIMIT:
            self.clear()
        cell = int(digest[:4], 16) % self.dimension + (int(digest[4], 16) % 2) * self.dimension
        self[token] = cell
        return cell


def vector_problems(df: DataFrame, vector: str, dimension: int, *more: Column) -> DataFrame:
    """One row: number of rows, of missing vectors and of wrong vector sizes, and ``more`` aggregates."""
    size = F.size(F.col(vector))
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(vector).isNull()).alias("missing"),
        F.count_if(F.col(vector).isNotNull() & (size != dimension)).alias("wrong_size"),
        *more,
    )


def check_vectors(df: DataFrame, vector: str, dimension: int | None = None) -> None:
    """Raise unless every row has a vector, all of ``dimension`` components.

    Without ``dimension`` they only have to be of one size. Components have to
    be finite numbers.
    """
    if dimension is None:
        dimension = df.agg(F.max(F.size(vector))).first()[0] or 0
    column = F.col(vector)
    # The largest component is NaN if any is; both ends are NULL if all are.
    low, high = F.array_min(column).cast("double"), F.array_max(column).cast("double")
    odd = F.isnan(high) | (high == float("inf")) | (low == float("-inf")) | F.exists(column, lambda v: v.isNull())
    # One pass over the vectors.
    found = vector_problems(df.withColumn("__odd", odd), vector, dimension, F.count_if("__odd").alias("odd")).first()
    if found["odd"]:
        raise ValueError("a vector has components that are no finite numbers")
    if found["missing"] or found["wrong_size"]:
        raise ValueError(
            f"{found['missing']} of {found['rows']} rows have no vector, "
            f"{found['wrong_size']} have not {dimension} components"
        )
