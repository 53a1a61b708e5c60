"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed character n-grams of unit length. Each
language has a few centroids, from spherical k-means over a bounded sample of
its texts, so that tables, verse or mixed texts need not share one centre with
prose. A text gets the language of the centroid with the largest cosine; one
that lies farther from it than nearly all texts the centroid was made of is
marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import id_remainder, sample_of_class, stored

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_BLOCK = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams of lower-case letters, with one blank for anything else.

    None if the text has no letter. The text is gone through in blocks, so the
    arrays stay small; each block goes on from the last two characters kept
    before it, so the counts are those of the whole text.
    """
    counts, some, text = np.zeros(BUCKETS), False, text.lower()
    tail, open_word = np.zeros(0, dtype=np.uint32), True
    for first in range(0, len(text), _BLOCK):
        points = np.frombuffer(text[first:first + _BLOCK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[points]
        some |= bool(letter.any())
        points = np.where(letter, points, np.uint32(32))
        before = np.concatenate([[open_word], letter[:-1]])
        points = points[letter | before]  # of a run of blanks only the first
        open_word = letter[-1]
        points = np.concatenate([tail, points])
        mixed = np.zeros(len(points), dtype=np.uint32)
        for n in range(1, 4):
            if len(points) < n:
                break
            mixed = (mixed[:len(points) - n + 1] ^ points[n - 1:]) * _FACTORS[n - 1]
            mixed ^= mixed >> np.uint32(15)
            own = mixed[max(0, len(tail) - n + 1):]  # those that end in this block
            counts += np.bincount(own >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
        tail = points[-2:]
    return counts if some else None


def unit_vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts) * weights
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


@dataclass
class Centroids:
    weights: np.ndarray  # inverse document frequencies
    centers: np.ndarray  # unit vectors
    languages: list[str]
    floors: np.ndarray  # the smallest cosine that is not rejected

    def nearest(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether rejected; ties go to the first language by name."""
        cosine = np.clip(unit_vectors(counts, self.weights) @ self.centers.T, 0, 1)
        best = cosine.argmax(1)
        top = cosine[np.arange(len(best)), best]
        return [self.languages[b] for b in best], top, top < self.floors[best]


def _clusters(vectors: np.ndarray, k: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from spread-out starts: centres, and the cosine of each vector with its centre."""
    centers = [vectors.mean(0)]
    for _ in range(min(k, len(vectors)) - 1):
        centers.append(vectors[np.argmin((vectors @ np.array(centers).T).max(1))])
    centers = np.array(centers)
    for _ in range(rounds):
        own = (vectors @ centers.T).argmax(1)
        sums = np.array([vectors[own == c].sum(0) for c in range(len(centers))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centers)
        if np.allclose(moved, centers, atol=1e-9):
            break
        centers = moved
    return centers, (vectors @ centers.T).argmax(1)


def fit(docs: DataFrame, per_language: int = 1200, per_centroid: int = 4, reject: float = 0.001) -> Centroids:
    """Centroids from ``docs(doc_id, text, lang)``: at most ``per_language`` different texts of each language.

    The chosen ids are broadcast, so texts that are not chosen stay where they
    are; ids may repeat, so the texts that have them are bounded once more.
    """
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")
    chosen = sample_of_class(known.select("doc_id", "lang"), "doc_id", F.col("lang"), per_language)
    texts = known.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi").select("lang", "text").distinct()
    texts = sample_of_class(texts.withColumn("key", F.xxhash64("text")), "key", F.col("lang"), per_language).drop("key")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts = ngram_counts(text)
                if counts is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([counts.astype(np.float32).tobytes()])], names=["lang", "counts"])

    sample = stored(texts.mapInArrow(count, "lang string, counts binary"), "language-sample")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS), 0
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_py(), np.float32) > 0
                rows += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([rows], pa.int64())],
                                         names=["total", "rows"])

    # The sample is bounded, so there are few partial sums.
    sums = sample.select("counts").coalesce(16).mapInArrow(frequencies, "total binary, rows bigint").collect()
    rows = sum(r.rows for r in sums)
    if not rows:
        return Centroids(np.ones(BUCKETS), np.zeros((0, BUCKETS)), [], np.zeros(0))
    weights = np.log((1 + rows) / (1 + sum(np.frombuffer(r.total) for r in sums))) + 0.05

    def centre(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        counts = np.array([np.frombuffer(c, np.float32) for c in sorted(own["counts"])])
        vectors = unit_vectors(counts, weights)
        centers, of = _clusters(vectors, per_centroid)
        made = [(c, vectors[of == i] @ c) for i, c in enumerate(centers) if (of == i).any()]
        return pd.DataFrame({"lang": key[0], "center": [c.tobytes() for c, _ in made],
                             "floor": [float(np.quantile(near, reject)) - 0.05 for _, near in made]})

    found = sample.groupBy("lang").applyInPandas(centre, "lang string, center binary, floor double").collect()
    found.sort(key=lambda r: (r.lang, r.center))
    return Centroids(weights, np.array([np.frombuffer(r.center) for r in found]), [r.lang for r in found],
                     np.array([r.floor for r in found]))


def identify(docs: DataFrame, model: Centroids, at_once: int = 256) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row.

    ``score`` is the cosine with the nearest centroid. Null texts and texts
    without a letter are ``und`` with score 0, and so are all texts if nothing
    was learned. Repeated rows are each answered, extra columns ignored; an
    empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                part = batch.slice(first, at_once)
                counts = [ngram_counts(t.as_py() or "") for t in part.column(1)]
                there = [i for i, c in enumerate(counts) if c is not None and model.languages]
                lang, score, rejected = [UNKNOWN] * len(counts), np.zeros(len(counts)), np.ones(len(counts), dtype=bool)
                if there:
                    names, cosine, far = model.nearest(np.array([counts[i] for i in there]))
                    score[there], rejected[there] = cosine, far
                    for i, name in zip(there, names):
                        lang[i] = name
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def language_of(docs: DataFrame, per_language: int = 1200) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from the rows that are not held out."""
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = fit(docs.where(~held_out), per_language)
    return identify(docs, model).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")
