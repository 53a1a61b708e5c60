import hashlib

import pytest
from pyspark.sql import functions as F

from shelfmark.llm.streaming_dedup import DedupState, exact_dedup, keep_first_of_each

_UP = {ord(u): l for u, l in zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
ROWS = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, None), (5, ""), (6, "É"), (7, "é"), (2, "abc"), (2, "abc"), (None, "abc"),
        (None, "only null ids"), (None, "only null ids"), (8, "x" * 100_000), (9, "X" * 100_000)]


def _expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(_UP), []).append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def _check(found, rows):
    expected = _expected(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in expected.items()}
    assert len(found) == len(rows)
    kept = {}
    for r in found:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] = kept.get(r.text_sha256, 0) + 1
    assert kept == dict.fromkeys(by_sha, 1)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "d", True) for r in rows], "doc_id bigint, text string, digest string, kept boolean")


def test_verdicts(spark):
    _check(exact_dedup(_frame(spark, ROWS)).collect(), ROWS)


def test_filter_leaves_one_row_of_each_text(spark):
    docs = _frame(spark, ROWS)
    left = keep_first_of_each(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").translate(_UP) for r in left.collect()]
    assert sorted(texts) == sorted(_expected(ROWS))


def test_state_goes_on_without_expiry(spark):
    state = DedupState(spark)
    state.feed(_frame(spark, ROWS[:6]))
    state.feed(_frame(spark, ROWS[6:]))
    again = DedupState(spark, state.folder)
    assert {(r.keep_id, r.group_size) for r in again.state().collect()} == set(_expected(ROWS).values())
    _check(again.verdicts(_frame(spark, ROWS)).collect(), ROWS)


def test_equal_digests_of_different_texts_are_told_apart(spark):
    state = DedupState(spark, digest=lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1))
    rows = [(i, f"text {i % 40}") for i in range(100)]
    docs = _frame(spark, rows)
    state.feed(docs)
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in state.verdicts(docs).collect()}
    for i, text in rows:
        same = [j for j, t in rows if t == text]
        assert found[i] == (max(same), len(same), i == max(same))


def test_no_python_on_the_executors(spark):
    plan = exact_dedup(_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("operator", [exact_dedup, keep_first_of_each])
def test_empty_table(spark, operator):
    assert operator(_frame(spark, [])).collect() == []
