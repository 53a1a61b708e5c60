import numpy as np

from shelfmark.llm import language_centroids as lc
from shelfmark.llm.common import id_remainder


def test_counts_do_not_depend_on_blocks(monkeypatch):
    texts = ["Ab cé, dd  e\n" * 500, "  x", "a", " - a - ", "ΣΑΣ ΣΑΣ. x", "日本 語😀x" * 9, "a1" * 50]
    whole = [lc.ngram_counts(t) for t in texts]
    assert lc.ngram_counts("12 -") is None and lc.ngram_counts("") is None
    assert (lc.ngram_counts("AB") == lc.ngram_counts("ab")).all()
    assert whole[2].sum() == 1 and whole[3].sum() == 3 + 2 + 1  # a blank, a letter, a blank
    for block in (1, 2, 3, 101):
        monkeypatch.setattr(lc, "_BLOCK", block)
        assert all((lc.ngram_counts(t) == w).all() for t, w in zip(texts, whole))


def test_sample_is_bounded_by_rows(spark):
    """One id holds most rows, so a sample of ids alone would hold most texts."""
    rows = [(1, f"word number {i} of many", "en") for i in range(300)] + [(2, "ein text", "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    taken = []

    def stored(df, label):
        taken.append(df.groupBy("lang").count().collect())
        return df

    original, lc.stored = lc.stored, stored
    try:
        model = lc.fit(docs, per_language=20)
    finally:
        lc.stored = original
    assert {r.lang: r["count"] for r in taken[0]} == {"en": 20, "de": 1}
    assert set(model.languages) == {"de", "en"}


def test_texts_stay_where_they_are(spark, folder):
    """The sample is fetched by a broadcast of its ids, not by a shuffle of all texts."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plans = []
    original, lc.stored = lc.stored, lambda df, label: plans.append(df) or original(df, label)
    try:
        lc.fit(docs)
    finally:
        lc.stored = original
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r for r in lc.language_of(docs).collect()}
    held = [r for r in docs.collect() if found[r.doc_id].held_out]
    assert held and sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.9 * len(held)
    for r in docs.select("doc_id", (id_remainder(docs["doc_id"], 3) == 1).alias("h")).collect():
        assert found[r.doc_id].held_out == r.h and 0 <= found[r.doc_id].score <= 1


def test_several_centroids_for_each_language():
    random = np.random.default_rng(0)
    vectors = np.concatenate([np.eye(8)[i] + random.normal(size=(30, 8)) * 0.02 for i in range(3)])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centers, of = lc._clusters(vectors, 3)
    assert sorted(centers.argmax(1)) == [0, 1, 2] and len({tuple(of[i:i + 30]) for i in (0, 30, 60)}) == 3


def test_odd_rows(spark):
    rows = [(i, f"the quick brown fox {i % 7} jumps", "en") for i in range(30)] + [
        (100 + i, f"der schnelle braune fuchs {i % 5} springt", "de") for i in range(30)]
    odd = [(900, None, "en"), (901, "", None), (902, "12 --", "de"), (903, "the fox " * 30_000, None), (None, "der fuchs", "de"),
           (904, "жжж ыыы", None), (904, "жжж ыыы", None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows + odd], "doc_id bigint, text string, lang string, score double")
    found = lc.language_of(docs).collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == lc.UNKNOWN and by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[903].lang_pred == "en" and by_id[None].lang_pred == "de"
    assert by_id[904].rejected and by_id[904].lang_pred in ("de", "en")
    assert not by_id[5].rejected
    nothing = lc.language_of(docs.select("doc_id", "text", docs["lang"].substr(100, 1).alias("lang")).where("lang IS NULL"))
    assert {r.lang_pred for r in nothing.collect()} == {lc.UNKNOWN}
    assert lc.language_of(docs.limit(0)).collect() == []
