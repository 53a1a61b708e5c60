"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson.

The covariance is never formed: it acts on a few vectors at a time through one
pass over the rows, in which every task multiplies its centred rows. A small
subspace is grown by the correction equations of Jacobi-Davidson, projected
against all wanted directions and solved by inner MINRES steps that share
their passes; Rayleigh-Ritz in the subspace gives new directions, and those
whose residual has reached double precision are locked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

_TASK_BYTES = 16 * 1024**2
_ROWS_AT_ONCE = 1 << 20  # numbers of a matrix that a task works on at a time
#: More tasks than this have their sums added by ``_ADDERS`` tasks before the driver sees them.
_DIRECT_TASKS, _ADDERS = 64, 16
#: Grid numbers above this would not leave room for exact products of 64 bits.
GRID_LIMIT = 1 << 40
_WIDEST = 1 << 62


# --- exact statistics -------------------------------------------------------

def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite numbers."""
    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))

    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def grid_vectors(rows: DataFrame, steps: int, shift: int) -> DataFrame:
    """id, x: every component as the whole number ``floor(steps * c) + shift``."""
    c = F.col("vector").cast("array<double>")
    beyond = F.exists(c, lambda v: F.abs(v * steps) >= GRID_LIMIT)
    x = F.when(beyond, F.raise_error(F.lit("a component is beyond the grid of whole numbers"))).otherwise(
        F.transform(c, lambda v: F.floor(v * steps).cast("bigint") + shift))
    return rows.where(usable(F.col("vector"))).select(F.col("id").cast("bigint").alias("id"), x.alias("x"))


def _matrices(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The ``x`` of a batch as whole-number matrices of bounded size."""
    column = batch.column(batch.schema.get_field_index("x"))
    if pc.any(pc.not_equal(pc.list_value_length(column), size)).as_py():
        raise ValueError(f"a vector does not have {size} components")
    step = max(1, _ROWS_AT_ONCE // size)
    for first in range(0, batch.num_rows, step):
        part = column.slice(first, step)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), size)


class FitList:
    """The stored whole-number vectors with their count, sums and centred products.

    ``n`` and the sums are exact. Centred entries are ``(n * x - S) / n``: the
    numerator is exact, so only the division rounds.
    """

    def __init__(self, vectors: DataFrame):
        self.vectors = stored(vectors, "grid-vectors")
        one = self.vectors.select(F.size("x").alias("d")).first()
        self.size = one.d if one else 0
        self.n, self.sums, self.passes = 0, np.zeros(0, dtype=np.int64), 0
        if not one:
            return
        self.tasks = self._tasks()
        sums = self._added(self._count_and_sum(), "n bigint, total array<bigint>")
        self.n = sum(r.n for r in sums)
        self.sums = np.array([sum(column) for column in zip(*(r.total for r in sums))], dtype=np.int64)

    def _tasks(self) -> int:
        rows = self.vectors.count()
        wanted = -(-rows * self.size * 8 // _TASK_BYTES)
        return max(1, wanted, min(self.vectors.sparkSession.sparkContext.defaultParallelism,
                                  -(-rows * self.size // _ROWS_AT_ONCE)))

    def _scan(self) -> DataFrame:
        # No shuffle: neighbouring small files are read by one task.
        return self.vectors.coalesce(self.tasks)

    def _count_and_sum(self) -> DataFrame:
        size = self.size

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total = 0, np.zeros(size, dtype=np.int64)
            for batch in batches:
                for x in _matrices(batch, size):
                    n, total = n + len(x), total + x.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.list_(pa.int64()))],
                                             names=["n", "total"])

        return self._scan().select("x").mapInArrow(add, "n bigint, total array<bigint>")

    def _added(self, partial: DataFrame, schema: str) -> list:
        """Rows of partial sums, at most ``_DIRECT_TASKS`` of them, for the driver."""
        if self.tasks <= _DIRECT_TASKS:
            return partial.collect()
        first, second = partial.columns

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total, shape = 0, None, None
            for batch in batches:
                shape = batch.schema
                for row in batch.to_pylist():
                    part = np.array(row[second])
                    n, total = n + row[first], part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_pylist([{first: n, second: total.tolist()}], schema=shape)

        return partial.repartition(_ADDERS).mapInArrow(add, schema).collect()

    @staticmethod
    def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        if len(x) and n * int(np.abs(x).max()) >= _WIDEST:
            raise OverflowError("count and components are too large for exact products of 64 bits")
        return n * x - sums

    def centred_sums(self, partial: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
        """The sum over all rows of what ``partial`` gives for matrices of centred rows (``length`` numbers)."""
        size, n, sums, deviations = self.size, self.n, self.sums, self.deviations

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(length)
            for batch in batches:
                for x in _matrices(batch, size):
                    total += partial(deviations(x, n, sums) / n)
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([total], pa.list_(pa.float64()))],
                                             names=["n", "total"])

        self.passes += 1
        schema = "n bigint, total array<double>"
        rows = self._added(self._scan().select("x").mapInArrow(add, schema), schema)
        return np.sum([r.total for r in rows], axis=0)

    def trace(self) -> float:
        return float(self.centred_sums(lambda c: np.array([np.einsum("ij,ij->", c, c)]), 1)[0]) / self.n

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``block``, in one pass."""
        found = self.centred_sums(lambda c: (c.T @ (c @ block)).ravel(), block.size)
        return found.reshape(block.shape) / self.n


# --- Jacobi-Davidson --------------------------------------------------------

def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``block`` add to ``against`` (orthonormal)."""
    kept: list[np.ndarray] = []
    for column in block.T:
        length = np.linalg.norm(column)
        if not length:
            continue
        v = column / length
        basis = np.column_stack([against, *kept]) if kept or against.size else against
        for _ in range(3):  # repeated, so that rounding leaves no part of the basis
            if basis.size:
                v = v - basis @ (basis.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        if left >= 1e-10:
            kept.append(v)
    return np.column_stack(kept) if kept else np.zeros((len(block), 0))


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, reduction: float) -> np.ndarray:
    """Solutions of a symmetric (indefinite) equation for each column of ``right``, by ``steps`` of MINRES.

    The columns share their products. A column stops changing when its residual
    has fallen by ``reduction``, or when its Krylov space is used up.
    """
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    v = np.divide(right, beta, out=np.zeros_like(right), where=beta > 0)
    before = np.zeros_like(v)
    w = w_before = np.zeros_like(v)
    c, s = np.ones_like(beta), np.zeros_like(beta)
    c_before, s_before = c.copy(), s.copy()
    left, coupling = beta.copy(), np.zeros_like(beta)
    active = beta > 0
    for _ in range(steps):
        if not active.any():
            break
        # Lanczos: the next direction.
        p = product(v) - coupling * before
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v
        following = np.linalg.norm(p, axis=0)
        # The column of the tridiagonal matrix under the last two rotations, and a new one.
        over = s_before * coupling
        upper = c_before * coupling
        diagonal = c * alpha - s * upper
        above = s * alpha + c * upper
        size = np.hypot(diagonal, following)
        live = active & (size > 0)
        safe = np.where(live, size, 1.0)
        c_new, s_new = np.where(live, diagonal / safe, 1.0), np.where(live, following / safe, 0.0)
        w_new = np.where(live, (v - above * w - over * w_before) / safe, 0.0)
        x = x + np.where(live, c_new * left * w_new, 0.0)
        left = np.where(live, -s_new * left, left)
        exhausted = following <= 1e-14 * np.maximum(size, np.abs(alpha))
        active = live & (np.abs(left) > reduction * start) & ~exhausted
        before, v = v, np.divide(p, following, out=np.zeros_like(p), where=following > 0)
        coupling, w_before, w = following, w, w_new
        c_before, s_before, c, s = c, s, c_new, s_new
    return x


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 11,
                       inner_steps: int = 4, most: int | None = None, tolerance: float = 2.0**-46,
                       rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and unit eigenvectors of a symmetric positive operator.

    ``product`` applies the operator to the columns of a matrix. A direction is
    locked when its residual is at most ``tolerance`` times the largest
    eigenvalue, which is what sums in double precision can give; locked ones
    are no longer corrected but stay in the subspace, whose Rayleigh-Ritz step
    orders them with the others. The subspace starts again from its best
    directions beyond ``most`` dimensions.
    """
    wanted = min(wanted, size)
    guard = min(size, wanted + 4)
    most = min(size, max(most or 8 * wanted, guard + wanted))
    random = np.random.default_rng(seed)
    basis = orthonormal(random.normal(size=(size, guard)), np.zeros((size, 0)))
    image = product(basis)
    for _ in range(rounds):
        small = basis.T @ image
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        ritz, ritz_image = basis @ mix[:, :wanted], image @ mix[:, :wanted]
        residual = ritz_image - ritz * values[:wanted]
        limit = tolerance * max(values[0], np.finfo(float).tiny)
        open_ = np.flatnonzero(np.linalg.norm(residual, axis=0) > limit)
        if not len(open_) or basis.shape[1] == size:
            # Once more with fresh products: images in the subspace carry the rounding of all rounds.
            ritz = orthonormal(ritz, np.zeros((size, 0)))
            fresh = product(ritz)
            small = ritz.T @ fresh
            values, mix = np.linalg.eigh((small + small.T) / 2)
            values, mix = values[::-1], mix[:, ::-1]
            residual = fresh @ mix - ritz @ mix * values
            if np.linalg.norm(residual, axis=0).max() <= 4 * limit:
                return values, ritz @ mix
            basis, image = ritz, fresh
            continue
        shifts = values[open_]

        def projected(t: np.ndarray, shifts: np.ndarray = shifts, ritz: np.ndarray = ritz) -> np.ndarray:
            t = t - ritz @ (ritz.T @ t)
            t = product(t) - t * shifts
            return t - ritz @ (ritz.T @ t)

        correction = minres(projected, -residual[:, open_], inner_steps, 0.01)
        if basis.shape[1] + len(open_) > most:
            basis, image = basis @ mix[:, :guard], image @ mix[:, :guard]
        added = orthonormal(correction, basis)
        if not added.shape[1]:
            added = orthonormal(random.normal(size=(size, 1)), basis)
        basis, image = np.hstack([basis, added]), np.hstack([image, product(added)])
    raise ArithmeticError(f"no convergence in {rounds} rounds")


# --- whitening --------------------------------------------------------------

def _squares(whole: np.ndarray) -> list[int]:
    """Exact sums of the squares of each row of whole numbers, whatever their size."""
    high, low = whole >> 31, whole & ((1 << 31) - 1)
    if not len(whole):
        return []
    if np.abs(high).max() >= 1 << 20 or whole.shape[1] >= 1 << 11:
        return [sum(int(v) ** 2 for v in row) for row in whole]
    # Sums of up to 2^11 terms below 2^40, 2^51 and 2^32 stay within 64 bits; the last square is cut in halves for that.
    hh, hl = (high * high).sum(axis=1), (high * low).sum(axis=1)
    square = low * low
    ll_high, ll_low = (square >> 32).sum(axis=1), (square & 0xFFFFFFFF).sum(axis=1)
    return [(int(a) << 62) + (int(b) << 32) + (int(c) << 32) + int(d) for a, b, c, d in zip(hh, hl, ll_high, ll_low)]


def whiten(rows: DataFrame, components: int = 8, steps: int = 1024, shift: int = 100_000) -> DataFrame:
    """``rows(id, vector)`` on their leading principal components, one row per vector and component.

    id, component (from 1, by falling eigenvalue), n, deviation (decimal, the
    exact squared length of ``n * x - S``), whitened, explained, identity_error
    and eigenvalue. ``x`` are the components as whole numbers
    ``floor(steps * c) + shift``.

    * Vectors that are null, empty, or hold null, NaN or infinite components take
      no part; vectors of unequal sizes, or with components beyond the grid
      (2^40), are errors.
    * Null and repeated ids are rows like any others, extra columns are ignored,
      an empty table gives no rows.
    * Components without variance (equal vectors, fewer vectors than components)
      cannot be scaled to one and are left out; of equal eigenvalues any basis
      is given, the same for all rows.
    """
    fit = FitList(grid_vectors(rows, steps, shift))
    schema = ("id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double, eigenvalue double")
    trace = fit.trace() if fit.n else 0.0
    if not trace:
        return rows.sparkSession.createDataFrame([], schema)
    values, vectors = leading_eigenpairs(fit.product, fit.size, components)
    present = values > max(values[0], 0) * fit.size * 2.0**-46
    values, vectors = values[present], vectors[:, present]
    scaled = vectors / np.sqrt(values)
    count = len(values)
    mean = fit.centred_sums(lambda c: (c @ scaled).sum(axis=0), count) / fit.n

    def products(c: np.ndarray) -> np.ndarray:
        w = c @ scaled - mean
        return (w.T @ w).ravel()

    covariance = fit.centred_sums(products, count * count).reshape(count, count) / fit.n
    error = float(np.abs(covariance - np.eye(count)).max())
    n, sums, size, explained = fit.n, fit.sums, fit.size, values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for x in _matrices(batch, size):
                whole = FitList.deviations(x, n, sums)
                whitened = (whole / n) @ scaled
                own = [Decimal(v) for v in _squares(whole)]
                ids = batch.column(0).slice(first, len(x))
                first += len(x)
                for i in range(count):
                    yield pa.RecordBatch.from_arrays([
                        ids, pa.array(np.full(len(x), i + 1, np.int32)), pa.array(np.full(len(x), n)),
                        pa.array(own, pa.decimal128(38, 0)), pa.array(np.ascontiguousarray(whitened[:, i])),
                        pa.array(np.full(len(x), explained[i])), pa.array(np.full(len(x), error)),
                        pa.array(np.full(len(x), values[i]))], names=[
                        "id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"])

    return fit.vectors.select("id", "x").mapInArrow(project, schema)
