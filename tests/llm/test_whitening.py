import numpy as np
import pytest

from shelfmark.llm import whitening
from shelfmark.llm.queries import QUERIES


def plain(vectors, components=8, steps=1024, shift=100_000):
    """Whitening by a dense eigendecomposition, and the exact squared lengths by whole numbers."""
    x = np.floor(steps * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + shift
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    exact = [sum(int(v) ** 2 for v in row) for row in n * x - sums]
    return centred @ directions / np.sqrt(values), values / np.einsum("ij,ij->", centred, centred) * n, exact


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [float(c) for c in v], 1, "x") for i, v in rows],
                                 "id bigint, vector array<double>, x int, whitened string").repartition(3)


def check(rows, vectors, components):
    whitened, explained, exact = plain(vectors, components)
    found = np.full(whitened.shape, np.nan)
    for r in rows:
        found[r.id, r.component - 1] = r.whitened
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.n == len(vectors) and r.deviation == exact[r.id] and r.identity_error < 1e-9
    sign = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found * sign - whitened).max() < 1e-8


@pytest.mark.parametrize("size, count", [(64, 400), (8, 60), (3, 40), (100, 300)])
def test_equals_dense_eigenvectors(spark, size, count):
    vectors = np.random.default_rng(size).normal(size=(count, size)) * np.linspace(2, 1, size)
    rows = whitening.whiten(frame(spark, [(i, list(v)) for i, v in enumerate(vectors)])).collect()
    assert len(rows) == count * min(size, 8)
    check(rows, vectors, min(size, 8))


def test_query_on_given_vectors(spark, folder):
    given = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    rows = QUERIES["op11_whitening"](spark, folder).collect()
    assert sorted({r.vec_id for r in rows}) == [r.vec_id for r in given] and len(rows) == 8 * len(given)
    whitened, explained, exact = plain([r.embedding for r in given])
    place = {r.vec_id: i for i, r in enumerate(given)}
    found = np.zeros(whitened.shape)
    for r in rows:
        found[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == exact[place[r.vec_id]] and r.identity_error < 1e-10
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    assert np.abs(found * np.sign((found * whitened).sum(axis=0)) - whitened).max() < 1e-8


def test_clustered_and_large_eigenvalues():
    """Residuals at double precision for equal eigenvalues, tiny ones and a subspace that starts again."""
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(200, 200)))
    for values in (np.r_[np.full(12, 5.0), np.linspace(4.9, 1, 188)], np.r_[1e12, np.geomspace(10, 1e-6, 199)],
                   np.linspace(1.001, 1, 200)):
        a = (q * values) @ q.T
        found, vectors = whitening.leading_eigenpairs(lambda b: a @ b, 200, 8)
        assert np.abs(found - np.sort(values)[::-1][:8]).max() <= 1e-13 * values.max()
        residual = np.linalg.norm(a @ vectors - vectors * found, axis=0)
        assert residual.max() <= 1e-13 * values.max()
        assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-13


def test_minres_solves_indefinite_equations():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(30, 30)))
    a = (q * np.r_[np.linspace(-3, -1, 10), np.linspace(1, 4, 20)]) @ q.T
    right = np.column_stack([rng.normal(size=(30, 3)), np.zeros(30)])
    x = whitening.minres(lambda b: a @ b, right, 60, 1e-13)
    assert np.abs(a @ x - right).max() < 1e-10 and not x[:, 3].any()


def test_odd_rows(spark):
    vectors = np.random.default_rng(4).normal(size=(50, 4))
    rows = [(i, list(v)) for i, v in enumerate(vectors)]
    odd = [(90, None), (91, []), (92, [1.0, float("nan"), 0, 0]), (93, [float("inf"), 0, 0, 0])]
    found = whitening.whiten(frame(spark, rows + odd)).collect()
    check(found, vectors, 4)
    assert len(found) == 200
    # Null and repeated ids, and a third of all rows equal, are rows like any others.
    repeated = [(7, list(vectors[0]))] * 25 + [(None, list(vectors[1]))] * 3 + rows
    assert len(whitening.whiten(frame(spark, repeated)).collect()) == 4 * 78
    with_null = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 2.0]), (3, [2.0, 1.0])], "id bigint, vector array<double>")
    assert {r.id for r in whitening.whiten(with_null).collect()} == {2, 3}


def test_no_variance_and_empty(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).collect()
    # Rounding to whole numbers is exact here, so the vectors lie on one line.
    assert {r.component for r in flat} == {1} and len(flat) == 9


def test_errors(spark):
    with pytest.raises(Exception, match="components"):
        whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0])]))
    with pytest.raises(Exception, match="beyond the grid"):
        whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1e30, 2.0])]))


def test_exact_squares():
    whole = np.array([[2**40 + 3, -(2**40) - 1, 5], [0, 0, 0], [-1, 2**31, -(2**31)], [2**55, 1, -(2**55)]])
    for part in (whole[:3], whole):
        assert whitening._squares(part) == [sum(int(v) ** 2 for v in row) for row in part]


def test_many_tasks_are_added_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_DIRECT_TASKS", 2)
    monkeypatch.setattr(whitening, "_TASK_BYTES", 500)
    vectors = np.random.default_rng(6).normal(size=(80, 3))
    table = frame(spark, [(i, list(v)) for i, v in enumerate(vectors)]).repartition(9)
    check(whitening.whiten(table).collect(), vectors, 3)
