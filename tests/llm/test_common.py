import pytest
from pyspark.sql import functions as F

from shelfmark.llm import common, simhash_vptree, streaming_dedup, toxicity_crf


@pytest.mark.parametrize("count, max_bytes", [(0, 1 << 25), (1, 1 << 25), (5000, 1 << 25), (5000, 4096)])
def test_no_key_is_missed_and_few_others_are_possible(spark, count, max_bytes):
    rows = spark.range(20_000).repartition(4)
    keys = spark.range(count).select(F.xxhash64("id").alias("hash"))
    marked = common.mark_possible(rows, F.xxhash64("id"), keys, "maybe", max_bytes=max_bytes)
    assert marked.where(f"id < {count} AND NOT maybe").isEmpty() and marked.count() == 20_000
    others = marked.where(f"id >= {count} AND maybe").count() / (20_000 - count)
    assert others <= (0.2 if max_bytes == 4096 else 0.08)
    assert marked.columns == ["id", "maybe"]


def test_without_rows(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, "b", 2), (None, "c", 3), (None, "c", 4), (3, None, 5), (4, "d", 6)],
                                 "id bigint, sha string, v int")
    verdicts = spark.createDataFrame([(1, "a", True, 2), (2, "b", False, 1), (None, "c", True, 2), (3, None, False, 1), (4, "d", True, 1)],
                                     "id bigint, sha string, kept boolean, copies bigint")
    found = common.without_rows(rows, ["id", "sha"], verdicts).collect()
    assert sorted((r.id or 0, r.sha) for r in found) == [(0, "c"), (1, "a"), (4, "d")]
    assert common.without_rows(rows, ["id", "sha"], verdicts.limit(0)).count() == 7
    assert common.without_rows(rows.limit(0), ["id", "sha"], verdicts).count() == 0


NAMES = ["_sha", "__found", "private_kinds", "new.x", "a`b", "kept", "id", "sha", "c0", "__possible", "part"]


def odd_columns(spark, texts):
    rows = [(i, t, *range(len(NAMES))) for i, t in enumerate(texts)]
    schema = ", ".join(["doc_id bigint", "text string", *(f"{common.quoted(n)} int" for n in NAMES)])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("stage", ["exact", "simhash", "toxic"])
def test_stages_keep_columns_of_any_name(spark, stage):
    texts = ["one two three four five six", "One two three four five six", "other words that stand alone here now", None, ""]
    docs = odd_columns(spark, texts)
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    kept = {"exact": lambda: streaming_dedup.keep_first_of_each(docs), "simhash": lambda: simhash_vptree.keep_one_of_each(docs),
            "toxic": lambda: toxicity_crf.reject_toxic(docs, labels)}[stage]()
    assert kept.schema == docs.schema
    found = sorted(kept.collect())
    ids = {"exact": [1, 2, 4], "simhash": [0, 2, 3], "toxic": [0, 1, 2, 3, 4]}[stage]
    assert [r.doc_id for r in found] == ids
    assert all(tuple(r)[2:] == tuple(range(len(NAMES))) and r.text == texts[r.doc_id] for r in found)


def test_texts_that_stay_are_not_shuffled(spark, tmp_path):
    odd_columns(spark, [f"text {i} of its own" for i in range(50)] + ["same"] * 3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = streaming_dedup.keep_first_of_each(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    # The first branch of the union is the one without candidates: it has only the broadcast of the bitmaps.
    first = plan[plan.index("Union"):].split("\n   :-" if "\n   :-" in plan else "\n:-")[1]
    assert "Exchange hashpartitioning(c" not in first
