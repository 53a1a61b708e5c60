"""Builds that broke off, and builds whose files are no longer what was written."""

import json
import os

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.embedding import hashing_provider
from shelfmark.plans.build_vectors import build_vectors
from shelfmark.sources.corpus import load_corpus
from shelfmark.sources.taxonomy import read_taxonomy
from shelfmark.sources.taxonomy_scan import scan_nodes


@pytest.fixture()
def taxonomy(tmp_path):
    nodes = [{"Code": i, "Title": f"T{i}", "Level": 1, "Childs": [{"Code": 100 * i + j, "Title": f"c{j}", "Level": 2} for j in range(9)]}
             for i in range(6)]
    (tmp_path / "t.json").write_text(json.dumps({"Schema": nodes}))
    return str(tmp_path / "t.json")


def counted(log, fail_after=None):
    def make():
        call = hashing_provider(4)()

        def embed(texts):
            if fail_after is not None and log.exists() and len(log.read_text().split()) >= fail_after:
                raise RuntimeError("out of quota")
            with open(log, "a") as out:
                out.write("x\n" * len(texts))
            return call(texts)
        return embed
    return make


def test_broken_build_repeats_no_finished_wave(spark, taxonomy, tmp_path):
    log, run, folder = tmp_path / "calls", str(tmp_path / "run"), str(tmp_path / "corpus")
    documents = read_taxonomy(spark, taxonomy)
    with pytest.raises(Exception, match="quota"):
        build_vectors(documents, folder, counted(log, 25), 4, run=run, waves=6)
    assert not os.path.exists(f"{folder}/manifest")
    before = len(log.read_text().split())
    corpus, lookup = build_vectors(documents, folder, counted(log), 4, run=run, waves=6, resume=True)
    after = len(log.read_text().split())
    assert corpus.count() == 60 and lookup.count() > 0 and 0 < before < after < before + 60
    corpus, _ = build_vectors(documents, folder, counted(log), 4, run=run, waves=6, resume=True)
    assert len(log.read_text().split()) == after
    plain, _ = build_vectors(documents, str(tmp_path / "plain"), counted(tmp_path / "other"), 4)
    assert plain.exceptAll(corpus).isEmpty() and plain.count() == 60
    with pytest.raises(ValueError, match="waves"):
        build_vectors(documents, folder, counted(log), 4, run=run, waves=2, resume=True)
    with pytest.raises(ValueError, match="documents"):
        build_vectors(documents.withColumn("content", F.replace("content", F.lit("T1"), F.lit("T9"))), folder, counted(log), 4,
                      run=run, waves=6, resume=True)


def test_nodes_cut_by_byte_ranges_build_the_same(spark, taxonomy, tmp_path):
    one, _ = build_vectors(read_taxonomy(spark, taxonomy), str(tmp_path / "a"), hashing_provider(4), 4)
    two, _ = build_vectors(scan_nodes(spark, taxonomy), str(tmp_path / "b"), hashing_provider(4), 4, run=str(tmp_path / "run"))
    assert one.exceptAll(two).isEmpty() and two.count() == 60


def test_a_corpus_that_lost_or_changed_rows_is_refused(spark, taxonomy, tmp_path):
    folder = str(tmp_path / "corpus")
    build_vectors(read_taxonomy(spark, taxonomy), folder, hashing_provider(4), 4, "m")
    corpus, lookup = load_corpus(spark, folder, "m", 4)
    assert corpus.count() == 60
    manifest = spark.read.json(f"{folder}/manifest").first()
    assert manifest.corpus_content.startswith("60:") and manifest.lookup_content.startswith(f"{lookup.count()}:")
    parts = sorted(n for n in os.listdir(f"{folder}/corpus") if n.endswith(".parquet"))
    kept = [(n, open(f"{folder}/corpus/{n}", "rb").read()) for n in parts]
    os.remove(f"{folder}/corpus/{parts[0]}")
    if len(parts) == 1:
        corpus.sparkSession.createDataFrame([], corpus.schema).write.mode("append").parquet(f"{folder}/corpus")
    with pytest.raises(ValueError, match="corpus in .* is not what was built"):
        load_corpus(spark, folder, "m", 4)
    assert load_corpus(spark, folder, "m", 4, check_content=False)[0].count() < 60
    for name, content in kept:
        with open(f"{folder}/corpus/{name}", "wb") as out:
            out.write(content)
    changed = spark.read.parquet(f"{folder}/lookup").withColumn("title", F.lit("other"))
    changed.write.parquet(f"{folder}/changed")
    os.rename(f"{folder}/lookup", f"{folder}/lookup-old")
    os.rename(f"{folder}/changed", f"{folder}/lookup")
    with pytest.raises(ValueError, match="lookup in .* other contents"):
        load_corpus(spark, folder, "m", 4)


def test_nodes_of_a_build_without_run_are_written_once(spark, taxonomy, tmp_path, monkeypatch):
    from shelfmark.plans import build_vectors as plan

    place = str(tmp_path / "place")
    monkeypatch.setattr(plan, "run_folder", lambda _: place)
    corpus, _ = build_vectors(read_taxonomy(spark, taxonomy), str(tmp_path / "one"), counted(tmp_path / "calls"), 4)
    assert sorted(os.listdir(place)) == ["nodes", "ranged-position"]
    assert len((tmp_path / "calls").read_text().split()) == 60
    other, _ = build_vectors(read_taxonomy(spark, taxonomy), str(tmp_path / "two"), hashing_provider(4), 4, waves=2)
    assert os.path.exists(f"{place}/vectors") and corpus.exceptAll(other).isEmpty() and corpus.count() == other.count() == 60


@pytest.mark.parametrize("odd", [None, float("nan"), float("inf"), float("-inf")])
def test_odd_components_are_found_in_one_pass(spark, odd, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from shelfmark.operators.embedding import check_vectors

    def refused(self):
        raise AssertionError("a second pass over the vectors")

    monkeypatch.setattr(DataFrame, "isEmpty", refused)
    rows = [(1, [1.0, 2.0]), (2, [1.0, odd]), (3, None)]
    with pytest.raises(ValueError, match="finite"):
        check_vectors(spark.createDataFrame(rows, "id int, v array<float>"), "v", 2)
    with pytest.raises(ValueError, match="finite"):
        check_vectors(spark.createDataFrame([(1, [odd, odd])], "id int, v array<float>"), "v", 2)
    with pytest.raises(ValueError, match="1 of 2 rows have no vector"):
        check_vectors(spark.createDataFrame([(1, [1.0, 2.0]), (3, None)], "id int, v array<float>"), "v", 2)
    check_vectors(spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>"), "v", 2)
