import numpy as np
import pytest

from shelfmark.llm import quality_rff as q


def test_features_approximate_a_gaussian_kernel():
    random = np.random.default_rng(0)
    size, width = len(q.STATISTICS), 3.0
    model = q.Quality(np.zeros(size), np.ones(size), random.normal(size=(size, 20_000)) / width,
                      random.uniform(0, 2 * np.pi, 20_000), np.zeros(20_001), np.zeros(q._BINS))
    x = random.normal(size=(6, size))
    z = model.features(x)[:, 1:]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * width ** 2))
    assert np.allclose(z @ z.T, kernel, atol=0.05)


def test_characters_of_all_planes():
    """Letters and marks beyond U+FFFF count like those below."""
    at = {name: i for i, name in enumerate(q.STATISTICS)}
    assert q.statistics("\U0001f600" * 4)[at["marks"]] == 1.0
    assert q.statistics("\U00010400\U00010428")[at["upper"]] == 0.5  # a capital and a small letter of Deseret
    assert q.statistics("\U0001d7d8")[at["digits"]] == 1.0
    assert q.statistics("\U000e0000")[at["marks"]] == 0.0


def test_isotonic_regression_against_a_plain_version():
    random = np.random.default_rng(1)
    bins = np.arange(0, 200, 5)
    shares, counts = random.random(40), random.integers(1, 9, 40).astype(float)
    fitted = q.isotonic(bins, shares, counts)[bins]
    assert (np.diff(fitted) >= -1e-12).all()
    for i in range(40):  # max-min formula
        value = max(min(np.average(shares[a:b + 1], weights=counts[a:b + 1]) for b in range(i, 40)) for a in range(i + 1))
        assert fitted[i] == pytest.approx(value)


def test_normal_equations_do_not_depend_on_partitions(spark):
    random = np.random.default_rng(2)
    rows = [(list(map(float, random.normal(size=len(q.STATISTICS)))), int(random.random() < 0.5)) for _ in range(500)]
    table = spark.createDataFrame(rows, "stats array<double>, quality int")
    one, many = q.fit(table.coalesce(1)), q.fit(table.repartition(7))
    assert np.allclose(one.weights, many.weights, atol=1e-6)
    x = one.features(np.array([r[0] for r in rows]))
    y = np.array([r[1] for r in rows], dtype=float)
    ridge = 1e-4 * len(rows) * np.diag([0.0] + [1.0] * 200) + 1e-9 * np.eye(201)
    assert np.allclose(one.weights, np.linalg.solve(x.T @ x + ridge, x.T @ y), atol=1e-6)


def test_held_out_documents(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in q.quality(docs, labels).collect()}
    assert len(found) == docs.count()
    held = [(r.quality, found[r.doc_id].predicted) for r in labels.collect() if found[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.85 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())


def test_odd_rows(spark):
    rows = [(i, f"some plain words {i}. And more of them" if i % 2 else "X!! Y!! " * 9) for i in range(60)]
    odd = [(900, None), (901, ""), (None, "a"), (902, "word " * 60_000), (902, "word " * 60_000), (903, "\n\n"), (904, "😀" * 9)]
    docs = spark.createDataFrame([(*r, 7) for r in rows + odd], "doc_id bigint, text string, stats int")
    labels = spark.createDataFrame([(i, i % 2, 0.0) for i in range(60)] + [(None, 1, 0.0), (61, None, 0.0)],
                                   "doc_id bigint, quality int, score double")
    found = q.quality(docs, labels).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (900, 901)}) == 1
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id < 60)
    assert {r.score for r in q.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert q.quality(docs.limit(0), labels).collect() == []
