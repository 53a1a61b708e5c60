"""Resumed runs, odd model answers and searches that must not depend on the plan."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.text import float_text
from shelfmark.operators.answers import parse_responses
from shelfmark.operators.chat import complete
from shelfmark.operators.embedding import check_vectors, hashing_provider
from shelfmark.operators.knn import nearest, search
from shelfmark.operators.prompts import PromptTexts, batch_prompts
from shelfmark.plans.embed_rows import embed_rows, embed_updates
from shelfmark.session import materialize
from shelfmark.sources.tables import apply_pending_updates, write_snapshot


def _table(spark, rows=40, name="row"):
    return spark.createDataFrame([(i, f"{name} {i}", None if i % 4 else "[1]") for i in range(rows)],
                                 "id bigint, name string, embedding_context string")


def _run(spark, folder, table=None, **options):
    table = _table(spark) if table is None else table
    return embed_rows(table, "id", ["name"], hashing_provider(4), 4, folder=folder, **options)


def test_resume_with_other_waves_is_refused(spark, tmp_path):
    folder = str(tmp_path / "run")
    assert _run(spark, folder, waves=5).where("embedding_context IS NULL").isEmpty()
    assert _run(spark, folder, waves=5, resume=True).where("embedding_context IS NULL").isEmpty()
    with pytest.raises(ValueError, match="waves"):
        _run(spark, folder, waves=1, resume=True)
    with pytest.raises(ValueError, match="texts"):
        _run(spark, folder, _table(spark, name="other"), waves=5, resume=True)


def test_finished_table_is_not_computed_again(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert materialize(make, "numbers", str(tmp_path), resume=True).count() == 3
    assert made == [1]


def test_vector_size_is_checked_at_the_call(spark, tmp_path):
    with pytest.raises(Exception, match="components"):
        embed_updates(_table(spark), "id", ["name"], hashing_provider(8), 4, folder=str(tmp_path / "a"), waves=4)
    vectors = spark.createDataFrame([([1.0, float("nan")],)], "v array<double>")
    with pytest.raises(ValueError, match="finite"):
        check_vectors(vectors, "v", 2)


@pytest.mark.parametrize("content, error", [
    ('[{"product_id": ' + "9" * 5000 + ', "choice": "A"}]', True),
    ('[{"product_id": 1, "choice": "\\ud83d"}]', False),
    ('[{"product_id": "\\ud83d", "choice": "A"}]', False),
    ('[{"product_id": 1e400, "choice": "A"}]', False),
])
def test_odd_answers_fail_their_batch_only(spark, content, error):
    good = '[{"product_id": 2, "choice": "A"}]'
    rows = spark.createDataFrame([(1, content), (2, good)], "batch bigint, content string")
    found = {r.batch: r for r in parse_responses(rows).collect()}
    assert (found[1].error is not None) == error
    assert found[2].error is None and found[2].answers[0].choice == "A"


@pytest.mark.parametrize("answer, error, tokens", [
    ({"content": "cut \ud83d", "usage": {"prompt_tokens": 3}}, False, 3),
    ({"content": 7, "usage": {}}, True, None),
    ({"content": "x", "usage": None}, False, None),
    ({"content": "x", "usage": {"prompt_tokens": "12"}}, False, None),
    ({"content": "x", "usage": {"prompt_tokens": 2**40}}, False, None),
    ("text", True, None),
])
def test_odd_completions_fail_their_row_only(spark, answer, error, tokens):
    def make():
        return lambda system, user: answer if user == "odd" else {"content": "[]", "usage": {"prompt_tokens": 1}}

    prompts = spark.createDataFrame([(1, "s", "odd"), (2, "s", "good")], "batch bigint, system_message string, user_message string")
    found = {r.batch: r for r in complete(prompts, make).collect()}
    assert (found[1].error is not None) == error and found[1].prompt_tokens == tokens
    assert found[2].content == "[]" and found[2].prompt_tokens == 1


def test_repeated_and_null_keys_are_searched_alike(spark):
    corpus = spark.createDataFrame([(i, f"d{i}", [float(i % 7), 1.0]) for i in range(30)] + [(30, "nan", [float("nan"), 1.0])],
                                   "position bigint, id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [0.0, 1.0]), (1, [6.0, 1.0]), (None, [3.0, 1.0]), (2, None)], "key bigint, vector array<float>")

    def positions(**options):
        return [(r.key, r.hits and [h.position for h in r.hits]) for r in nearest(queries, corpus, k=3, **options).collect()]

    plain = positions()
    assert plain == [(1, [0, 7, 14]), (1, [6, 13, 20]), (None, [3, 10, 17]), (2, None)]
    assert positions(block_bytes=1) == positions(block_bytes=40) == positions(block_bytes=40, kept_bytes=0) == plain
    one = [r.position for r in search(corpus, [3.0, 1.0], 3).collect()]
    assert (None, one) in plain
    small = corpus.where("position >= 28")
    for size in (1, 1000):
        assert [h.position for h in nearest(queries.limit(1), small, k=3, block_bytes=size).first().hits][:2] == [28, 29]


def test_finished_rows_pass_without_a_shuffle(spark, tmp_path):
    _table(spark).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    updates = spark.createDataFrame([(1, "new"), (4, "never")], "id bigint, embedding_context string")
    done = apply_pending_updates(table, updates, "id", ["embedding_context"], "embedding_context")
    found = {r.id: r.embedding_context for r in done.collect()}
    assert len(found) == 40 and found[1] == "new" and found[4] == "[1]" and found[2] is None
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Join") == 1


def test_snapshot_paths_are_compared_by_component(spark, tmp_path):
    _table(spark).write.parquet(str(tmp_path / "products-classified"))
    table = spark.read.parquet(str(tmp_path / "products-classified"))
    assert write_snapshot(table, str(tmp_path / "products")).count() == 40
    with pytest.raises(ValueError):
        write_snapshot(table, str(tmp_path / "products-classified"))


def test_own_prompt_texts(spark):
    texts = PromptTexts("system", "{n} rows:", "end")
    rows = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id bigint, batch bigint, block string")
    row = batch_prompts(rows, "id", texts=texts).first()
    assert (row.system_message, row.user_message) == ("system", "2 rows:abend")


def test_float_texts_compile(spark):
    values = [0.1, 1e7, 1.5e16, 1e-5, 123456789.123, -2.5e-4, 1e-300, 1.7976931348623157e308]
    table = spark.createDataFrame([(v,) * 6 for v in values], ", ".join(f"v{i} double" for i in range(6)))
    texts = table.select(*[float_text(F.col(f"v{i}")).alias(f"t{i}") for i in range(6)])
    code = texts._jdf.queryExecution().debug().codegenToSeq()
    assert all(len(code.apply(i)._2()) < 200_000 for i in range(code.size()))
    assert [r.t0 for r in texts.collect()] == [repr(v) for v in values]
    assert json.loads(f"[{','.join(r.t5 for r in texts.collect())}]") == values
