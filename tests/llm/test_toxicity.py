import itertools

import numpy as np
import pytest

from shelfmark.llm.queries import QUERIES
from shelfmark.llm import toxicity_crf as crf


def _by_enumeration(emissions, transitions):
    n, total = len(emissions), 0.0
    marginal, pairs = np.zeros(n), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum(e * t for e, t in zip(emissions, tags)) + sum(
            transitions[a, b] for a, b in zip(tags, tags[1:])))
        total += weight
        marginal += weight * np.array(tags)
        for a, b in zip(tags, tags[1:]):
            pairs[a, b] += weight
    return marginal / total, pairs / total


def test_marginals_against_enumeration(monkeypatch):
    monkeypatch.setattr(crf, "_SEGMENT", 3)
    random = np.random.default_rng(0)
    lengths = np.array([1, 7, 0, 4, 3, 9, 2])
    emissions, transitions = random.normal(size=lengths.sum()) * 2, random.normal(size=(2, 2))
    found, at = crf.marginals(emissions, lengths, transitions), 0
    for n in lengths:
        marginal, pairs = _by_enumeration(emissions[at:at + n], transitions)
        assert np.allclose(found[at:at + n], marginal)
        if n > 1:
            own = crf._pair_marginals(emissions[at:at + n], np.array([n]), transitions, found[at:at + n], np.arange(1, n))
            assert np.allclose(own, pairs)
        at += n


def test_segments_do_not_change_long_texts(monkeypatch):
    random = np.random.default_rng(1)
    emissions, transitions = random.normal(size=5000), random.normal(size=(2, 2))
    whole = crf.marginals(emissions, np.array([5000]), transitions)
    monkeypatch.setattr(crf, "_SEGMENT", 7)
    assert np.allclose(whole, crf.marginals(emissions, np.array([5000]), transitions))


@pytest.fixture(scope="module")
def trained(spark):
    random = np.random.default_rng(3)
    plain = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = list(random.choice(plain, 40))
        if i % 4 == 0:
            for place in random.integers(0, 40, 3):
                words[place] = str(random.choice(["Vile", "vileness", "awful"]))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(a, c, 0) for a, _, c in rows], "doc_id bigint, toxic int, score int")
    return docs, labels, rows


def test_held_out_documents_are_told_apart(trained):
    docs, labels, rows = trained
    found = {r.doc_id: r for r in crf.toxicity(docs, labels).collect()}
    truth = {a: c for a, _, c in rows}
    held = [r for r in found.values() if r.held_out]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    texts = {a: b for a, b, _ in rows}
    for r in found.values():
        for span in r.spans:
            assert all(w.lower()[:4] in ("vile", "awfu") for w in texts[r.doc_id][span.begin:span.stop].split())


def test_odd_rows(spark, trained):
    docs, labels, _ = trained
    model = crf.fit(docs, labels)
    odd = [(1, None), (2, ""), (3, "123 --"), (None, "vile awful"), (4, "vile"), (4, "vile"), (5, "word1 " * 50_000)]
    found = crf.score(spark.createDataFrame(odd, "doc_id bigint, text string"), model).collect()
    assert len(found) == len(odd)
    blank = [r.score for r in found if r.doc_id in (1, 2, 3)]
    assert len(set(blank)) == 1 and blank[0] < 0.5
    kept = crf.reject_toxic(spark.createDataFrame(
        [(*r, 0.5, "s") for r in odd], "doc_id bigint, text string, score double, spans string"), labels)
    assert kept.columns == ["doc_id", "text", "score", "spans"]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    for rows in ([], [(1, 0)], [(1, None), (None, 1)]):
        labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        assert [r.predicted for r in crf.toxicity(docs, labels).collect()] == [0]
    assert crf.toxicity(docs.limit(0), spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")).collect() == []


def test_few_labels_do_no_harm(spark):
    """With some 30 toxic labels the held-out rows are judged no worse than by calling everything clean."""
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in rows)
    assert right >= len(rows) - sum(truth[r.doc_id] for r in rows)


def test_repeated_ids_do_not_unbound_the_sample(spark):
    docs = spark.range(600).selectExpr("1 AS doc_id", "concat('word ', id, ' stupid') AS text").unionByName(
        spark.range(20).selectExpr("id + 2 AS doc_id", "concat('fine text ', id) AS text"))
    labels = spark.createDataFrame([(1, 1), (1, 1), *((i, 0) for i in range(2, 22))], "doc_id bigint, toxic int")
    model = crf.fit(docs, labels, per_class=10)
    assert isinstance(model, crf.ChainModel)
