"""Properties of the physical plans."""

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog import queries
from catalog.queries import QUERIES
from shelfmark.operators import knn, prompts
from shelfmark.operators.candidates import candidate_rows, with_candidates

# These run jobs while they are built; their plans are those of written tables.
LAZY = sorted(n for n in QUERIES if not n.startswith("job_") and n not in ("corpus_roundtrip", "failure_log"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loop_or_cartesian_product(name, spark, folder):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_search_and_candidates_need_no_shuffle(spark, folder):
    found = with_candidates(knn.nearest(fx.query_vectors(spark, folder), fx.resolved_corpus(spark, folder)))
    assert "Exchange" not in plan(found)
    rows = plan(candidate_rows(found, "query_id"))
    assert rows.count("ArrowEvalPython") == 1 and rows.count("FileScan") == 1
    # The array of candidates is built once.
    assert rows.count("array_distinct") == 1


def test_search_plan_is_the_same_for_any_block_size(spark, folder):
    queries, corpus = fx.query_vectors(spark, folder), fx.resolved_corpus(spark, folder, "position")
    plans = [plan(knn.nearest(queries, corpus, block_bytes=size, kept_bytes=kept)) for size, kept in ((1, 0), (1 << 30, 1 << 30))]
    for text in plans:
        assert "Exchange" not in text and "Broadcast" not in text and text.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("texts", [prompts.STANDARD, prompts.PLAIN])
def test_one_wide_shuffle_up_to_the_prompt(spark, folder, texts):
    text = plan(queries._prompts(spark, folder, texts))
    wide = [line for line in text.splitlines() if "Exchange" in line and "Single" not in line and "Broadcast" not in line]
    assert len(wide) == 1 and "shufflepartitionidpassthrough" in wide[0]
    # What is shuffled are candidates and prompt texts, no vectors.
    shuffled = text[text.index(wide[0]):].splitlines()[1]
    assert "block" in text and "embedding" not in shuffled.split("[")[1].split("CASE")[0]


def test_pending_filter_reaches_the_scan(spark, folder, tmp_path):
    fx.products(spark, folder).write.parquet(f"{tmp_path}/products")
    stored = spark.read.parquet(f"{tmp_path}/products")
    text = plan(stored.where(F.col("gs1_segment").isNull()).select("product_id"))
    assert "IsNull(gs1_segment)" in text and "embedding_context" not in text
