import json
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.chat import first_option_provider
from shelfmark.operators.embedding import embed, hashing_provider
from shelfmark.operators.metadata import resolve_metadata
from shelfmark.plans.classify import classify
from shelfmark.plans.embed_rows import embed_rows
from shelfmark.session import work_dir
from shelfmark.sources.corpus import lookup_rows

TARGETS = ["gs1_segment", "gs1_family", "gs1_class", "gs1_brick", "gs1_attribute", "gs1_attribute_value"]


@pytest.fixture(scope="module")
def corpus(spark):
    paths = [["Food"], ["Food", "Bakery"], ["Food", "Bakery", "Bread", "White Bread"], ["Food", "Bakery", "Bread", "Brown Bread"],
             ["Toys", "Games", "Board", "Chess"], ["Toys", "Games", "Board", "Chess", "Wood"]]
    rows = [(i, str(100 + i), " ".join(p), len(p), str(100 + i), p[-1], p, " > ".join(p)) for i, p in enumerate(paths)]
    nodes = spark.createDataFrame(
        rows, "position bigint, id string, text string, level int, code string, title string, hierarchy_path array<string>, hierarchy_string string"
    )
    documents = nodes.withColumn("embedding", embed(F.col("text"), hashing_provider(32)))
    return resolve_metadata(documents, lookup_rows(documents))


def product_table(spark, n=25):
    names = ["White Bread", "Chess Board Wood", "Bakery", "Brown Bread"]
    rows = [(i, names[i % 4], None, "Done" if i == 3 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, name string, embedding_context string, gs1_segment string")
    for c in TARGETS[1:]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def counting_provider(folder, dimension=32):
    def make():
        call = hashing_provider(dimension)()

        def counted(texts):
            with open(f"{folder}/calls", "a") as log:
                log.write(f"{len(texts)}\n")
            return call(texts)
        return counted
    return make


def test_embed_rows_resumes(spark, tmp_path):
    table = product_table(spark).withColumn("embedding_context", F.when(F.col("id") < 5, "[9.0]"))
    once = embed_rows(table, "id", ["name"], counting_provider(str(tmp_path)), 32)
    rows = {r.id: r for r in once.collect()}
    once.count()
    calls = [int(x) for x in (tmp_path / "calls").read_text().split()]
    assert sum(calls) == 20 and max(calls) <= 256
    assert rows[1].embedding_context == "[9.0]" and len(json.loads(rows[9].embedding_context)) == 32
    again = embed_rows(once, "id", ["name"], counting_provider(str(tmp_path)), 32)
    assert again.exceptAll(once).isEmpty()
    assert len((tmp_path / "calls").read_text().split()) == len(calls)
    with pytest.raises(Exception, match="components"):
        embed_rows(table, "id", ["name"], hashing_provider(8), 32).collect()


def test_broken_run_goes_on_where_it_stopped(spark, tmp_path):
    table, folder, calls = product_table(spark, 40), str(tmp_path / "run"), tmp_path / "seen"

    def provider(broken):
        def make():
            call = hashing_provider(4)()

            def counted(texts):
                if broken and calls.exists() and len(calls.read_text().split()) >= 15:
                    raise RuntimeError("out of quota")
                with open(calls, "a") as log:
                    log.write("x\n" * len(texts))
                return call(texts)
            return counted
        return make

    with pytest.raises(Exception, match="quota"):
        embed_rows(table, "id", ["name"], provider(True), 4, folder=folder, waves=6)
    before = len(calls.read_text().split())
    done = embed_rows(table, "id", ["name"], provider(False), 4, folder=folder, waves=6, resume=True)
    assert done.where("embedding_context IS NOT NULL").count() == 40
    after = len(calls.read_text().split())
    # Only the wave that broke off may be embedded twice.
    assert 0 < before < after < before + 40


def test_call_size_and_array_targets(spark):
    seen = []
    df = spark.range(1000).select(F.col("id").cast("string").alias("t")).coalesce(1)

    def make():
        def call(texts):
            assert 0 < len(texts) <= 256
            return [[float(t), 1.0] for t in texts]
        return call

    rows = df.select("t", embed(F.col("t"), make).alias("v")).collect()
    assert len(rows) == 1000 and all(r.v == [float(r.t), 1.0] for r in rows) and not seen
    table = product_table(spark, 3).withColumn("embedding_context", F.lit(None).cast("array<float>"))
    done = embed_rows(table, "id", ["name"], hashing_provider(4), 4)
    assert done.schema == table.schema and all(len(r.embedding_context) == 4 for r in done.collect())


def test_classify_end_to_end(spark, corpus):
    table = embed_rows(product_table(spark), "id", ["name"], hashing_provider(32), 32)
    run = classify(table, corpus, "id", first_option_provider(), ["name"], TARGETS, dimensions=32)
    rows = {r.id: r for r in run.table.collect()}
    assert len(rows) == 25 and rows[3].gs1_segment == "Done" and rows[3].gs1_brick is None
    assert [rows[0][c] for c in TARGETS] == ["Food", "Bakery", "Bread", "White Bread", "", ""]
    assert rows[1].gs1_brick == "Chess" and rows[1].gs1_attribute == "Wood"
    assert rows[2].gs1_family == "Bakery"
    assert tuple(run.summary.first()) == (24, 0, 24, 3)
    assert run.failures.isEmpty() and run.unresolved.isEmpty() and run.unmatched.isEmpty()
    assert run.categories.agg(F.sum("classified")).first()[0] == 24
    assert run.responses.count() == 3
    second = classify(run.table, corpus, "id", first_option_provider(), ["name"], TARGETS, dimensions=32)
    assert tuple(second.summary.first()) == (0, 0, 0, 0) and second.responses.isEmpty()


def test_keys_that_tell_no_rows_apart_are_refused_or_listed(spark, corpus):
    table = embed_rows(product_table(spark), "id", ["name"], hashing_provider(32), 32)
    odd = table.withColumn("id", F.when(F.col("id") == 4, None).when(F.col("id") == 6, 7).otherwise(F.col("id")))
    called = []

    def provider():
        called.append(1)
        raise RuntimeError("asked")

    with pytest.raises(ValueError, match="no key None.*repeated key 7|repeated key 7.*no key None"):
        classify(odd, corpus, "id", provider, ["name"], TARGETS, dimensions=32)
    run = classify(odd, corpus, "id", first_option_provider(), ["name"], TARGETS, dimensions=32, refuse=False)
    assert {(r.id, r.rows, r.problem) for r in run.refused.collect()} == {(None, 1, "no key"), (7, 2, "repeated key")}
    rows = run.table.collect()
    assert len(rows) == 25 and sum(r.gs1_segment is None for r in rows) == 3
    assert tuple(run.summary.first()) == (21, 0, 21, 3)


def test_classify_failures_stay_in_their_batch(spark, corpus):
    table = embed_rows(product_table(spark, 64), "id", ["name"], hashing_provider(32), 32)
    table = table.withColumn(
        "embedding_context",
        F.when(F.col("id") == 5, "[broken").when(F.col("id") == 15, None).otherwise(F.col("embedding_context")),
    )

    def provider():
        def call(system, user):
            ids = [int(i) for i in re.findall(r"--- Product (\d+) ---", user)]
            usage = {"prompt_tokens": 1, "completion_tokens": 1, "total_tokens": 2}
            if 24 in ids:
                raise RuntimeError("rate limit")
            if 34 in ids:
                return {"content": "sorry", "usage": usage}
            answers = [{"product_id": i, "choice": "A"} for i in ids if i != 42]
            if 44 in ids:
                answers += [{"product_id": 44, "choice": "B"}, {"product_id": 45, "choice": "??"}, {"product_id": 1, "choice": "A"}]
            return {"content": json.dumps({"results": answers}), "usage": usage}
        return call

    run = classify(table, corpus, "id", provider, ["name"], TARGETS, dimensions=32)
    # Pending ids are 0..63 without 3: batch 1 ends at id 10, batch 2 at 20 and so on.
    errors = {(r.batch, r.error) for r in run.failures.select("batch", "error").distinct().collect()}
    assert errors == {
        (1, "malformed vector"), (3, "rate limit"), (4, "Could not parse LLM response after JSON and regex attempts"),
    }
    assert run.failures.count() == 30
    unresolved = {r.id: r.vector_status for r in run.unresolved.collect()}
    assert unresolved == {15: "skipped", 42: "ok"}
    assert {(r.ordinal, r.choice) for r in run.unmatched.collect()} == {(10, "??"), (11, "A")}
    # Batch 2: 9 rows, batch 5: 9 rows and one twice, batch 6: 10, batch 7: 3.
    assert tuple(run.summary.first()) == (9 + 10 + 10 + 3, 30, 62, 7)
    rows = {r.id: r for r in run.table.collect()}
    assert rows[5].gs1_segment is None and rows[42].gs1_segment is None and rows[41].gs1_segment is not None
    first, second = [c for c in run.results.where("id = 44").orderBy("ordinal").collect()]
    assert rows[44].gs1_family == second.gs1_family and first.ordinal < second.ordinal


def test_resumed_classification_repeats_no_call(spark, corpus, tmp_path):
    table = embed_rows(product_table(spark), "id", ["name"], hashing_provider(32), 32)
    folder = str(tmp_path / "run")
    one = classify(table, corpus, "id", first_option_provider(), ["name"], TARGETS, dimensions=32, folder=folder, waves=2)

    def dead():
        raise RuntimeError("called again")

    two = classify(table, corpus, "id", dead, ["name"], TARGETS, dimensions=32, folder=folder, waves=2, resume=True,
                   failure_path=f"{tmp_path}/failures")
    assert one.table.exceptAll(two.table).isEmpty() and tuple(two.summary.first()) == (24, 0, 24, 3)
    assert not (tmp_path / "failures").exists()


def test_any_block_size_gives_the_same_table(spark, corpus):
    table = embed_rows(product_table(spark), "id", ["name"], hashing_provider(32), 32)
    one = classify(table, corpus, "id", first_option_provider(), ["name"], TARGETS, dimensions=32)
    two = classify(table, corpus, "id", first_option_provider(), ["name"], TARGETS, dimensions=32, block_bytes=1)
    assert one.table.exceptAll(two.table).isEmpty() and two.table.count() == 25


def test_vectors_of_another_size_and_lean_metadata(spark, corpus):
    table = embed_rows(product_table(spark, 12), "id", ["name"], hashing_provider(32), 32)
    table = table.withColumn("embedding_context", F.when(F.col("id") == 0, "[1.0]").otherwise(F.col("embedding_context")))
    lean = corpus.select("position", "id", "embedding", "hierarchy_path")
    run = classify(table, lean, "id", first_option_provider(), ["name"], TARGETS)
    assert tuple(run.summary.first()) == (1, 10, 11, 2)
    row = run.table.where("id = 11").first()
    assert row.gs1_brick == "Brown Bread" and row.gs1_attribute == ""


def test_orchestrated_example(spark, corpus):
    flat = corpus.withColumn("embedding", F.array_repeat(F.lit(0.1).cast("float"), 1024)).where("position = 2")
    table = spark.createDataFrame([(1, "Whole grain bread", json.dumps([0.1] * 1024), None)], "id int, product_name string, embedding_context string, gs1_segment string")
    for c in TARGETS[1:]:
        table = table.withColumn(c, F.lit(None).cast("string"))
    run = classify(table, flat, "id", first_option_provider(), ["product_name"], TARGETS, dimensions=1024)
    assert run.table.first().gs1_segment == "Food"


def test_work_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", "")
    assert work_dir(spark) == configured.rstrip("/") or not configured
