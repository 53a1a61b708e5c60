"""Exact nearest neighbours by squared L2 distance of unit vectors.

Scores are given to twelve decimals, beyond which they are rounding noise, and
hits are ordered by (score, position), so equal scores have a fixed order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pa_fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark import fixed
from shelfmark.session import materialize

SCORE_DECIMALS = 12
BLOCK_BYTES = 8 * 1024**2
KEPT_BYTES = 64 * 1024**2
# Documents and queries of one single-precision product, which stays in a core's cache.
TILE = 1024
# Pairs whose exact scores are computed at once, in numbers.
EXACT_NUMBERS = 500_000
# Hits handed to Spark at once, and corpus rows read at once for what these show.
HITS_AT_ONCE = 60_000
ROWS_AT_ONCE = 8_192


def search(corpus: DataFrame, vector: Sequence[float], k: int = fixed.TOP_K) -> DataFrame:
    """``k`` nearest documents of one vector, ascending: corpus columns and ``score``.

    One pass over the corpus; each task keeps its own best ``k``. The distance
    is an Arrow function because the array expressions, which Spark interprets
    one component at a time, take three times as long at 256 components.
    """
    unit, _ = _unit(np.array([vector], dtype=np.float32))

    @F.arrow_udf("double")
    def distance(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            gap = _unit(_matrix(vectors))[0] - unit if len(vectors) else np.empty((0, 1))
            yield pa.array(np.einsum("ij,ij->i", gap, gap).round(SCORE_DECIMALS))

    scored = corpus.withColumn("score", distance.asNondeterministic()("embedding"))
    return scored.drop("embedding").orderBy("score", "position").limit(k)


def nearest(queries: DataFrame, corpus: DataFrame, vector: str = "vector", k: int = fixed.TOP_K,
            block_bytes: int = BLOCK_BYTES, kept_bytes: int = KEPT_BYTES, folder: str | None = None) -> DataFrame:
    """``queries`` without ``vector`` but with ``hits``, its ``k`` nearest documents.

    ``corpus`` has ``position``, ``id``, ``embedding`` and metadata columns
    (see ``resolve_metadata``). ``hits`` is an array of structs: score,
    position, id, metadata; NULL where the query has no vector.

    The corpus is written once to the shared folder and the queries are not
    shuffled: for each batch of them a task goes through the stored corpus in
    blocks of about ``block_bytes`` and keeps a running best ``k``. A worker
    process keeps blocks of up to ``kept_bytes`` decoded for its next batches
    and reads the rest again, so the corpus may be of any size. Reading costs
    little beside the product: a block is compared with a whole batch. Blocks
    hold vectors and positions only; what the hits show is read once they are
    known, and they are handed over a few thousand at a time.
    """
    result = hits_type(corpus)
    arrow_type = to_arrow_type(result)
    stored = materialize(corpus.withColumn("embedding", F.col("embedding").cast("array<float>")), "blocks", folder)
    files = sorted(stored.inputFiles())
    for file in files[:1]:
        _open(file).close()

    @F.arrow_udf(result)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        blocks = block_set(files, k, block_bytes, kept_bytes)
        for vectors in batches:
            yield from blocks.hits(vectors, arrow_type)

    # Marked so that Catalyst never copies the search into a pushed-down filter.
    return queries.withColumn("hits", hits.asNondeterministic()(F.col(vector))).drop(vector)


def hits_type(corpus: DataFrame) -> T.ArrayType:
    payload = [f for f in corpus.schema.fields if f.name not in ("embedding", "position")]
    return T.ArrayType(T.StructType([
        T.StructField("score", T.DoubleType()),
        T.StructField("position", corpus.schema["position"].dataType),
        *[T.StructField(f.name, f.dataType) for f in payload],
    ]))


def _open(file: str) -> pa.NativeFile:
    """A file of the shared folder, opened by a worker process."""
    uri = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", file))
    try:
        system, path = pa_fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ValueError) as error:
        raise ValueError(f"{file}: the search needs a work folder on file, hdfs, s3, gs or abfs") from error
    return system.open_input_file(path)


_sets: dict[tuple, BlockSet] = {}


def block_set(files: list[str], k: int, block_bytes: int, kept_bytes: int) -> BlockSet:
    """The blocks of the corpus that this worker process searched last, or of a new one."""
    key = (*files, k, block_bytes, kept_bytes)
    if key not in _sets:
        _sets.clear()
        _sets[key] = BlockSet(files, k, block_bytes, kept_bytes)
    return _sets[key]


class BlockSet:
    """A stored corpus as a sequence of blocks, the first of them kept, and the exact search in all of them."""

    def __init__(self, files: list[str], k: int, block_bytes: int, kept_bytes: int):
        self.files, self.k, self.block_bytes, self.kept_bytes = files, k, block_bytes, kept_bytes
        self.kept: list[CorpusBlock] = []
        self.ended = False  # whether the kept blocks are all there are
        self.rows: dict[str, int] = {}  # of each file

    def blocks(self) -> Iterator[CorpusBlock]:
        yield from self.kept
        if self.ended:
            return
        held = sum(b.size for b in self.kept)
        keeping, skip = True, len(self.kept)
        for number, (first, table) in enumerate(self._tables()):
            if number < skip:
                continue
            block = CorpusBlock(table, self.k, first)
            held += block.size
            keeping = keeping and held <= self.kept_bytes
            if keeping:
                self.kept.append(block)
            yield block
        self.ended = keeping

    def _tables(self) -> Iterator[tuple[int, pa.Table]]:
        """Vectors and positions in tables of about ``block_bytes`` of vectors, whatever the sizes of the files.

        Each comes with the place of its first row among all rows of the corpus.
        """
        parts: list[pa.RecordBatch] = []
        held = first = 0
        for name in self.files:
            with _open(name) as source, pq.ParquetFile(source) as file:
                rows = self.rows[name] = file.metadata.num_rows
                if not rows:
                    continue
                values = max(1, _leaf_values(file, "embedding"))
                step = max(1, self.block_bytes * rows // (4 * values))
                for batch in file.iter_batches(batch_size=step, columns=["embedding", "position"]):
                    parts.append(batch)
                    held += 4 * len(batch.column("embedding").values)
                    if held >= self.block_bytes:
                        table = pa.Table.from_batches(parts).combine_chunks()
                        parts, held = [], 0
                        yield first, table
                        first += len(table)
        if parts:
            yield first, pa.Table.from_batches(parts).combine_chunks()

    def hits(self, vectors: pa.Array, arrow_type: pa.DataType) -> Iterator[pa.Array]:
        """One list of hits per vector, NULL for NULL, in arrays of about ``HITS_AT_ONCE`` hits."""
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        present = vectors.is_valid().to_numpy(zero_copy_only=False)
        counts = np.zeros(len(vectors), dtype=np.int64)
        best = Best(int(present.sum()), self.k)
        if present.any():
            queries = _matrix(vectors.drop_null())
            unit, norm = _unit(queries)
            for block in self.blocks():
                block.search(unit, norm > 0, best)
        counts[present], score, found = best.result()
        place = found.column("place").to_numpy()
        payload = [f.name for f in arrow_type.value_type if f.name != "score"]
        offsets = np.concatenate([[0], np.cumsum(counts)])
        step = max(1, HITS_AT_ONCE // self.k)
        for first in range(0, max(1, len(vectors)), step):
            ends = offsets[first:first + step + 1]
            part = slice(ends[0], ends[-1])
            wanted, row = np.unique(place[part], return_inverse=True)
            rows = self._shown(wanted, payload).take(pa.array(row)) if len(wanted) else None
            columns = [
                pa.array(score[part]) if f.name == "score" else
                rows.column(f.name).combine_chunks().cast(f.type) if rows is not None else pa.nulls(0, f.type)
                for f in arrow_type.value_type
            ]
            yield pa.ListArray.from_arrays(
                pa.array((ends - ends[0]).astype(np.int32)),
                pa.StructArray.from_arrays(columns, fields=list(arrow_type.value_type)),
                type=arrow_type, mask=pa.array(~present[first:first + step]),
            )

    def _shown(self, places: np.ndarray, columns: list[str]) -> pa.Table:
        """``columns`` of the corpus rows at the ascending ``places``, in that order."""
        parts: list[pa.Table] = []
        start = 0
        for name in self.files:
            end = start + self.rows[name]
            if np.searchsorted(places, start) < np.searchsorted(places, end):
                with _open(name) as source, pq.ParquetFile(source) as file:
                    for batch in file.iter_batches(batch_size=ROWS_AT_ONCE, columns=columns):
                        low, high = np.searchsorted(places, [start, start + len(batch)])
                        if low < high:
                            parts.append(pa.Table.from_batches([batch]).take(pa.array(places[low:high] - start)))
                        start += len(batch)
            start = end
        return pa.concat_tables(parts).combine_chunks()


def _leaf_values(file: pq.ParquetFile, column: str) -> int:
    """How many numbers a list column holds, by the file's footer."""
    footer, leaves = file.metadata, [file.schema.column(i).path.split(".")[0] for i in range(len(file.schema))]
    return sum(footer.row_group(g).column(leaves.index(column)).num_values for g in range(footer.num_row_groups))


class Best:
    """The best ``k`` documents so far of each of ``count`` queries, by (score, position)."""

    def __init__(self, count: int, k: int):
        self.k = k
        self.score = np.full((count, k), np.inf)
        self.position = np.zeros((count, k), dtype=np.int64)
        self.place = np.full((count, k), -1, dtype=np.int64)  # row of the stored corpus
        self.waiting: dict[int, list[tuple[np.ndarray, ...]]] = {}  # by the first query of a tile
        self.number: dict[int, int] = {}  # of what is waiting

    def add(self, first: int, count: int, row: np.ndarray, score: np.ndarray, position: np.ndarray,
            place: np.ndarray) -> None:
        """Documents found for queries ``first + row``; they are merged when there are about ``k`` for each query."""
        self.waiting.setdefault(first, []).append((row, score, position, place))
        self.number[first] = self.number.get(first, 0) + len(row)
        if self.number[first] >= self.k * count:
            self._merge(first)

    def _merge(self, first: int) -> None:
        row, score, position, place = (np.concatenate(parts) for parts in zip(*self.waiting.pop(first)))
        self.number[first] = 0
        # Only queries with something new are sorted.
        touched, row = np.unique(row, return_inverse=True)
        window = first + touched
        old = np.nonzero(self.place[window] >= 0)
        rows = np.concatenate([old[0], row])
        scores = np.concatenate([self.score[window][old], score])
        positions = np.concatenate([self.position[window][old], position])
        places = np.concatenate([self.place[window][old], place])
        order = np.lexsort((positions, scores, rows))
        ordered = rows[order]
        rank = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        order, rank = order[rank < self.k], rank[rank < self.k]
        rows = window[rows[order]]
        for held, values in ((self.score, scores), (self.position, positions), (self.place, places)):
            held[rows, rank] = values[order]

    def result(self) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        """Hits of each query, then scores, positions and places of all in order."""
        for first in list(self.waiting):
            self._merge(first)
        filled = self.place >= 0
        return filled.sum(axis=1), self.score[filled], pa.table(
            {"position": self.position[filled], "place": self.place[filled]})


class CorpusBlock:
    """Vectors and positions of corpus rows held by one worker process, and the exact search in them."""

    def __init__(self, table: pa.Table, k: int, first: int = 0):
        self.k = k
        raw = _matrix(table.column("embedding").combine_chunks())
        position = table.column("position").to_numpy()
        order = np.argsort(position, kind="stable")
        keep = order[_first_copies(raw[order], k)]
        norm = _length(raw)[keep]
        # All that have no finite length score NaN, so the first k of them by position are enough.
        odd = ~np.isfinite(norm)
        chosen = ~odd | (np.cumsum(odd) <= k)
        keep, norm = keep[chosen], norm[chosen]
        self.raw, self.position, self.place = raw[keep], position[keep], first + keep
        self.zero = ~(norm > 0) & np.isfinite(norm)
        self.norm = np.where(norm > 0, norm, 1.0)
        # With the doubled vectors that a search makes of it.
        self.size = 3 * self.raw.nbytes + self.norm.nbytes + self.position.nbytes + self.place.nbytes

    def search(self, unit: np.ndarray, nonzero: np.ndarray, best: Best) -> None:
        """Merge what this block holds for queries of unit length into ``best``."""
        if unit.shape[1] != self.raw.shape[1]:
            raise ValueError(f"query vectors have {unit.shape[1]} components, corpus vectors {self.raw.shape[1]}")
        asked = unit.astype(np.float32)
        for start in range(0, len(self.raw), TILE):
            part = slice(start, start + TILE)
            doubled = (-2 * (self.raw[part] / self.norm[part, None]).astype(np.float32)).T
            for first in range(0, len(unit), TILE):
                tile = slice(first, first + TILE)
                self._search_some(start, doubled, first, asked[tile], unit[tile], nonzero[tile], best)

    def _search_some(self, start: int, doubled: np.ndarray, first: int, asked: np.ndarray, unit: np.ndarray,
                     nonzero: np.ndarray, best: Best) -> None:
        """Single-precision product, then exact scores of all that can be in the best k.

        ``near`` differs from the exact score (less the query's own square and
        1) by at most ``slip``, the worst-case rounding of a dot product of
        unit vectors. A document of the exact best k is therefore within
        ``slip`` of the k-th best score of earlier documents, and within
        ``2 * slip`` of the k-th smallest value of its row, which is looked for
        only where the earlier ones leave too many.
        """
        near = asked @ doubled
        documents = slice(start, start + near.shape[1])
        near[:, self.zero[documents]] = -1
        slip = 2.0 * (unit.shape[1] + 8) * 2.0**-24
        bound = best.score[first:first + len(unit), -1] - nonzero - 1 + slip
        bound[np.isnan(bound)] = np.inf
        hit = near <= _above(bound)
        if near.shape[1] > self.k and np.count_nonzero(hit) > 2 * self.k * len(unit):
            # NaN comes last, and never bounds the others.
            limit = np.partition(near, self.k - 1, axis=1)[:, self.k - 1] + 2 * slip
            bound = np.fmin(bound, limit)
            hit = near <= _above(bound)
        hit[np.isinf(bound)] = True  # fewer than k have a score: those without one come in
        odd = ~np.isfinite(asked).all(axis=1)
        if odd.any():  # no document has a score, the first positions are the best
            hit[odd] = np.arange(start, start + near.shape[1]) < self.k
        row, column = np.divmod(_places(hit), near.shape[1])
        if not len(row):
            return
        column += start
        score = np.empty(len(row))
        step = max(1, EXACT_NUMBERS // unit.shape[1])
        for i in range(0, len(row), step):
            r, c = row[i : i + step], column[i : i + step]
            gap = unit[r] - self.raw[c] / self.norm[c, None]
            score[i : i + step] = np.einsum("ij,ij->i", gap, gap).round(SCORE_DECIMALS)
        best.add(first, len(unit), row, score, self.position[column], self.place[column])


def _places(hit: np.ndarray) -> np.ndarray:
    """Flat places of what is true, which is little: eight at a time where they fill words."""
    flat = np.ascontiguousarray(hit).ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64))
    places = (8 * words[:, None] + np.arange(8)).ravel()
    return places[flat[places]]


def _above(bound: np.ndarray) -> np.ndarray:
    """The bounds as a column in single precision, one step up: none may round below a value that it allows."""
    return np.nextafter(bound.astype(np.float32), np.float32(np.inf))[:, None]


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Float rows of a list column; rows of unequal length are an error."""
    if not len(vectors):
        return np.empty((0, 0), np.float32)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    lengths = np.diff(vectors.offsets.to_numpy())
    if lengths.min() != lengths.max():
        raise ValueError(f"vectors have from {lengths.min()} to {lengths.max()} components")
    return values.reshape(len(vectors), lengths[0])


def _unit(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = _length(raw)
    return raw.astype(np.float64) / np.where(norm > 0, norm, 1.0)[:, None], norm


def _length(raw: np.ndarray) -> np.ndarray:
    """Lengths in double precision, a few rows at a time."""
    norm = np.empty(len(raw))
    for i in range(0, len(raw), ROWS_AT_ONCE):
        wide = raw[i : i + ROWS_AT_ONCE].astype(np.float64)
        norm[i : i + ROWS_AT_ONCE] = np.sqrt(np.einsum("ij,ij->i", wide, wide))
    return norm


def _first_copies(raw: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that have ``k`` equal rows before them.

    Equal vectors have equal scores and the lower position goes first, so the
    rows left out cannot be among any best ``k``.
    """
    if len(raw) <= k:
        return np.arange(len(raw))
    # Rows with different sums of their bits, each times a number of its place, are different.
    places = np.random.default_rng(0).integers(1, 2**63, raw.shape[1], dtype=np.uint64) | np.uint64(1)
    sums = np.ascontiguousarray(raw).view(np.uint32) @ places
    if len(np.unique(sums)) == len(raw):
        return np.arange(len(raw))
    bits = np.ascontiguousarray(raw).view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel()
    _, group = np.unique(bits, return_inverse=True)
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    nth = np.arange(len(raw)) - np.searchsorted(ordered, ordered)
    return np.sort(order[nth < k])
