import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import cross_polytope as cp


def _exact(rows, queries, k):
    out = {}
    for q, v in set(queries):
        a = np.array(v)
        scored = sorted((-float(np.dot(a, np.array(w)) / (np.linalg.norm(a) * np.linalg.norm(w))), i) for i, w in set(rows) if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows],
                                 "id bigint, vector array<double>")


def test_rotation_keeps_lengths():
    index = cp.CrossPolytope(50, 2, 1)
    x = np.random.default_rng(0).normal(size=(20, 50))
    for table in range(2):
        assert np.allclose(np.linalg.norm(index.rotated(x, table), axis=1), np.linalg.norm(x, axis=1))
    y = index.rotated(x, 0)
    nearest = np.where(np.abs(y).max(1) == y.max(1), y.argmax(1), index.width + (-y).argmax(1))
    assert (index.buckets(x, 0, 1)[:, 0] == nearest).all()


def test_all_buckets_give_the_exact_result(spark):
    random = np.random.default_rng(2)
    rows = [(i, tuple(random.normal(size=16))) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(2000 + i, tuple(2 * np.array(rows[9][1]))) for i in range(3)]
    queries = rows[:12]
    for settings in ({"tables": 1, "probes": 32}, {"tables": 2, "probes": 99, "cell_rows": 25}):
        found = cp.search(_frame(spark, rows), _frame(spark, queries), **settings).orderBy("query_id", "rank").collect()
        own = {q: [(r.id, r.score) for r in found if r.query_id == q] for q, _ in queries}
        for q, expected in _exact(rows, queries, 5).items():
            assert [i for i, _ in own[q]] == [i for i, _ in expected]
            assert np.allclose([s for _, s in own[q]], [s for _, s in expected], atol=1e-14)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, (1, 0)), (1, None), (2, (0, 0)), (3, (nan, 1)), (4, (inf, 1)), (5, (None, 1)), (6, (1, 1)), (6, (1, 1)),
            (None, (1, 0)), (7, (-1, 0)), (50, (1, 0)), (100, (0, 0))]
    table = _frame(spark, rows).withColumn("bucket", F.lit("x"))
    found = cp.search(table, table.where("id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.id) for r in found] == [
        (0, 1, 50), (0, 2, 6), (0, 3, 7), (50, 1, 0), (50, 2, 6), (50, 3, 7)]


def test_recall(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = {(r.query_id, r.id) for r in cp.search(vectors, vectors.where("id % 50 = 0")).collect()}
    rows = [(r.id, tuple(r.vector)) for r in vectors.collect()]
    exact = {(q, i) for q, own in _exact(rows, [r for r in rows if r[0] % 50 == 0], 5).items() for i, _ in own}
    assert len(found & exact) >= 0.9 * len(exact)


def test_empty_and_uneven(spark):
    empty = _frame(spark, [])
    assert cp.search(empty, empty).collect() == []
    assert cp.search(_frame(spark, [(0, (1, 2))]), _frame(spark, [(0, (1, 2))])).collect() == []
    with pytest.raises(Exception, match="components"):
        bad = _frame(spark, [(0, (1, 2)), (1, (1, 2, 3))])
        cp.search(bad, bad).collect()
