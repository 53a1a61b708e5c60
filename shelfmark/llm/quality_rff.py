"""Document quality by ridge regression on random Fourier features.

Statistics of a document are standardised and mapped to cosines of random
projections, which approximate a Gaussian kernel. The normal equations of the
ridge regression are summed within partitions and then over partitions, so any
number of labelled rows is used. Isotonic regression over binned scores turns
the result into a probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import id_remainder, stored

STATISTICS = [
    "log_chars", "log_words", "word_chars", "short_words", "distinct_words", "distinct_pairs", "repeated_neighbours",
    "upper", "digits", "marks", "spaces", "commonest_mark", "bars", "distinct_lines", "log_line_chars", "compressed",
    "mark_words",
]
_BINS, _LOW, _HIGH = 2000, -0.5, 1.5
_SUMS = 16


@cache
def _classes() -> np.ndarray:
    """0 other, 1 lower case, 2 upper case, 3 digit, 4 space, 5 mark, for every code point."""
    def of(c: str) -> int:
        if c.isalpha():
            return 2 if c.isupper() else 1
        return 3 if c.isdigit() else 4 if c.isspace() else 5 if c.isprintable() else 0

    return np.array([of(chr(c)) for c in range(0x110000)], dtype=np.uint8)


def statistics(text: str | None) -> list[float]:
    """The numbers of ``STATISTICS``; a null or empty text has zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _classes()[points]
    share = np.bincount(kind, minlength=6) / len(points)
    marks = np.bincount(points[(kind == 5) & (points < 128)], minlength=128)
    words = text.split()
    n, lines = max(len(words), 1), text.split("\n")
    encoded = text.encode("utf-8", "surrogatepass")
    letters = share[1] + share[2]
    return [
        np.log1p(len(text)), np.log1p(len(words)), min(len(text) / n, 50.0), sum(len(w) <= 3 for w in words) / n,
        len(set(words)) / n, len(set(zip(words, words[1:]))) / n, sum(map(eq, words, words[1:])) / n,
        share[2] / letters if letters else 0.0, share[3], share[5], share[4], marks.max() / len(points),
        text.count("|") / n, len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)),
        len(zlib.compress(encoded, 1)) / len(encoded), sum(not w[-1].isalnum() for w in words) / n,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and an array of the statistics of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, stats array<double>")


@dataclass
class Quality:
    mean: np.ndarray
    spread: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # calibrated probability at the centre of each bin

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        waves = np.cos(x @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack([np.ones(len(x)), waves])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        centers = _LOW + (np.arange(_BINS) + 0.5) * (_HIGH - _LOW) / _BINS
        return np.interp(self.raw(stats), centers, self.knots)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def fit(labelled: DataFrame, features: int = 200, width: float = 3.0, ridge: float = 1e-4, seed: int = 11) -> Quality:
    """Model from ``labelled(stats, quality)``, over all of its rows.

    What reaches the driver is ``_SUMS`` sums of the normal equations and the
    counts of the calibration's bins, whatever the number of rows.
    """
    size = len(STATISTICS)
    moments = labelled.select(F.count(F.lit(1)).alias("n"), *[
        f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(size)
        for name, f in (("mean", F.avg), ("spread", F.stddev_pop))]).first()
    random = np.random.default_rng(seed)
    model = Quality(
        np.array([moments[f"mean{i}"] or 0.0 for i in range(size)]),
        np.array([max(moments[f"spread{i}"] or 0.0, 1e-6) for i in range(size)]),
        random.normal(size=(size, features)) / width, random.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.full(_BINS, 0.5))
    if not moments.n:
        return model

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                x = model.features(_matrix(part.column(0)))
                total += x.T @ np.column_stack([x, part.column(1).to_numpy(zero_copy_only=False)])
        yield pa.RecordBatch.from_arrays([
            pa.array([int(np.abs(total).sum() * 1e3) % _SUMS], pa.int32()), pa.array([total.tobytes()])],
            names=["part", "total"])

    def add(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"total": [sum(np.frombuffer(t) for t in parts["total"]).tobytes()]})

    rows = labelled.select("stats", F.col("quality").cast("double").alias("quality"))
    sums = rows.mapInArrow(equations, "part int, total binary").groupBy("part").applyInPandas(add, "total binary")
    total = sum(np.frombuffer(r.total) for r in sums.collect()).reshape(features + 1, features + 2)
    left = total[:, :-1] + ridge * moments.n * np.diag([0.0] + [1.0] * features)
    model.weights = np.linalg.solve(left + 1e-9 * np.eye(len(left)), total[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip((model.raw(_matrix(batch.column(0))) - _LOW) / (_HIGH - _LOW) * _BINS, 0, _BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), batch.column(1)], names=["bin", "quality"])

    counts = rows.mapInArrow(binned, "bin int, quality double").groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("quality").alias("share")).collect()
    model.knots = isotonic(np.array([r.bin for r in counts]), np.array([r.share for r in counts]),
                           np.array([r.n for r in counts], dtype=float))
    return model


def isotonic(bins: np.ndarray, shares: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rising step function nearest to ``shares``, by pooling neighbours that fall; filled in for all bins."""
    pools: list[list[float]] = []  # first bin, last bin, count, share
    for i in np.argsort(bins):
        pools.append([bins[i], bins[i], counts[i], shares[i]])
        while len(pools) > 1 and pools[-2][3] >= pools[-1][3]:
            _, last, n, share = pools.pop()
            first, _, m, other = pools[-1]
            pools[-1] = [first, last, m + n, (m * other + n * share) / (m + n)]
    places = np.array([p for pool in pools for p in (pool[0], pool[1])])
    return np.interp(np.arange(_BINS), places, np.repeat([p[3] for p in pools], 2))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from the labels that are not held out.

    Null and empty texts have the statistics of an empty text. Repeated rows
    are scored each, extra columns ignored. Without labels every score is one
    half; an empty table of documents gives no rows.
    """
    stats = stored(document_statistics(docs), "statistics")
    usable = labels.where((id_remainder(F.col("doc_id"), 5) != 0) & F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    model = fit(stored(stats.join(usable, "doc_id").select("stats", "quality"), "quality-rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.clip(model.score(_matrix(batch.column(1))), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
