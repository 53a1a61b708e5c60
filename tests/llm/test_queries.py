"""Training-data queries against their SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline
from shelfmark.llm import packing
from shelfmark.llm.oracles import ORACLES
from shelfmark.llm.queries import PACK_TOKENIZER, QUERIES
from shelfmark.llm.streaming_dedup import exact_dedup


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(name, spark, folder):
    database = duckdb.connect()
    for table in ("documents", "pages"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = QUERIES[name](spark, folder)
    cursor = database.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))


def _write(spark, docs, path):
    docs.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = _write(spark, stage(spark, docs, folder), tmp_path / name)
        assert docs.columns == columns
        kept[name] = docs.collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    known = [labels[r.doc_id] for r in kept["toxicity"] if r.doc_id in labels]
    assert sum(known) <= 0.5 * sum(labels.values())
    assert len(known) - sum(known) >= 0.95 * (len(labels) - sum(labels.values()))
    lower = [r.text.lower() for r in kept["exact_dedup"]]
    assert len(set(lower)) == len(lower) and set(lower) == {r.text.lower() for r in kept["toxicity"]}
    assert {r.doc_id for r in kept["simhash"]} <= {r.doc_id for r in kept["exact_dedup"]}
    assert sorted(r.doc_id for r in kept["pii"]) == sorted(r.doc_id for r in kept["simhash"])
    assert all(r.n_chars == len(r.text) for r in kept["pii"])
    name, stage = corpus_pipeline.STAGES[-1]
    packed = stage(spark, docs, folder).collect()
    encoder = packing.TextEncoder(PACK_TOKENIZER)
    tokens = {r.doc_id: len(encoder.encode(r.text)) // 4 + 1 for r in kept["pii"]}
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == tokens


def test_stages_with_odd_rows(spark, folder, tmp_path):
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (3, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5), (None, "d", "en", "s", 1),
            (4, "w " * 50_000, "en", "s", 100_000), (5, "A b c", "en", "s", 5)]
    for count in (len(rows), 0):
        docs = spark.createDataFrame(
            [(*r, "x", 1.0) for r in rows[:count]],
            "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, root double")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = _write(spark, stage(spark, docs, folder), tmp_path / f"{name}{count}")
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        texts = [(r.text or "").lower() for r in docs.collect()]
        assert len(texts) == len(set(texts)) and len(exact_dedup(docs).where("kept").collect()) == len(texts)
        corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
