import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.embedding import hashing_provider
from shelfmark.operators.tree import flatten_tree
from shelfmark.plans.build_vectors import build_vectors
from shelfmark.sources.corpus import load_corpus, save_corpus
from shelfmark.sources.taxonomy import read_taxonomy, top_nodes

TREE = {
    "Schema": [
        {
            "Code": 50000000, "Title": "  Food ", "Level": 1, "Definition": " All food ", "Active": True,
            "Childs": [
                {"Code": "50100000", "Title": "Bakery", "Level": 2, "Definition": None, "DefinitionExcludes": "Cakes",
                 "Childs": [
                     {"Code": 1, "Title": "Bread", "Level": 3, "Childs": [
                         {"Code": 11, "Title": "White Bread", "Level": 4, "Childs": [
                             {"Code": 21, "Title": "Sliced", "Level": 5, "Childs": [{"Code": 31, "Title": "Yes", "Level": 6}]},
                         ]},
                         {"Code": 12, "Title": "Brown Bread", "Level": 4, "Active": False, "Childs": None},
                     ]},
                 ]},
                {"Title": "No code"},
            ],
        },
        {"Code": None, "Title": None, "Level": 1},
    ]
}


def walk(node, path, place, out):
    path = path + [(node.get("Title") or "").strip()]
    out.append((place, str(node["Code"]) if "Code" in node else "", path, node.get("Level", 0)))
    for i, child in enumerate(node.get("Childs") or []):
        walk(child, path, place + [i], out)


def expected_nodes(tree):
    nodes = tree["Schema"] if isinstance(tree["Schema"], list) else [tree["Schema"]]
    out = []
    for i, node in enumerate(nodes):
        walk(node, [], [i], out)
    return sorted(out)


def flat(df):
    return [(r.place, r.id, r.hierarchy_path, r.level) for r in df.orderBy("position").collect()]


@pytest.mark.parametrize("spread", [None, 4])
def test_flatten_is_preorder(spark, tmp_path, spread):
    (tmp_path / "t.json").write_text(json.dumps(TREE, indent=1), encoding="utf-8")
    nodes = flatten_tree(top_nodes(read_taxonomy(spark, str(tmp_path))), spread=spread)
    assert flat(nodes) == expected_nodes(TREE)
    rows = {r.title: r for r in nodes.collect()}
    assert rows["Food"].text == "Food | All food"
    assert rows["Bakery"].text == "Food > Bakery | Excludes: Cakes"
    assert rows["White Bread"].active and not rows["Brown Bread"].active
    assert (rows["No code"].id, rows["No code"].level) == ("", 0)
    assert rows[""].id == "None"
    assert sorted(r.position for r in nodes.collect()) == list(range(9))


def test_deep_tree_single_node_and_bom(spark, tmp_path):
    node = {"Code": 0, "Title": "n0"}
    for i in range(1, 15):
        node = {"Code": i, "Title": f"n{i}", "Childs": [node]}
    (tmp_path / "deep.json").write_text(json.dumps({"Schema": node}), encoding="utf-8-sig")
    nodes = flatten_tree(top_nodes(read_taxonomy(spark, str(tmp_path))))
    assert flat(nodes) == expected_nodes({"Schema": node})


@pytest.mark.parametrize("encoding", ["iso-8859-1", "utf-16"])
def test_other_encodings(spark, tmp_path, encoding):
    (tmp_path / "t.json").write_bytes(json.dumps({"Schema": {"Title": "Käse"}}, ensure_ascii=False).encode(encoding))
    nodes = flatten_tree(top_nodes(read_taxonomy(spark, str(tmp_path), encoding)))
    assert nodes.first().title == "Käse"


@pytest.mark.parametrize("content", [
    '{"Other": []}', '{"Schema": null}', '{"Schema": 5}', "", "no json", "[]", None,
    '{"Schema": [{"Title": "a"}, {"Title": "b"', '{"Schema": [{"Title": "a"}, {"Title": "b" "c"}]}', '{"Schema": {"Title": "a"',
])
def test_missing_or_broken_schema_is_an_error(spark, content):
    documents = spark.createDataFrame([("d", content)], "document string, content string")
    with pytest.raises(Exception, match="Schema"):
        top_nodes(documents).collect()


def test_empty_schema_has_no_nodes(spark):
    documents = spark.createDataFrame([("d", '{"Schema": []}')], "document string, content string")
    assert flatten_tree(top_nodes(documents)).isEmpty()


def test_document_larger_than_a_variant(spark, tmp_path):
    nodes = [{"Code": i, "Title": f"t{i}", "Definition": "d" * 1_000_000, "Childs": [{"Code": -i}]} for i in range(140)]
    (tmp_path / "big.json").write_text(json.dumps({"Schema": nodes}))
    found = top_nodes(read_taxonomy(spark, str(tmp_path)))
    assert found.count() == 140


def test_build_and_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.json").write_text(json.dumps(TREE))
    folder = str(tmp_path / "out")
    documents = read_taxonomy(spark, str(tmp_path / "in"))
    corpus, lookup = build_vectors(documents, folder, hashing_provider(16), 16, model="hash-16")
    assert corpus.count() == 9
    assert lookup.where("key = '11'").first().title == "White Bread"
    dump = [json.loads(r.value) for r in spark.read.text(f"{folder}/metadata").collect()]
    assert [d["position"] for d in sorted(dump, key=lambda d: d["position"])] == list(range(9))
    archive = spark.read.parquet(f"{folder}/archive")
    assert {f.dataType.simpleString() for f in archive.schema} == {"string"}
    vector = json.loads(archive.where("id = '11'").first().embedding)
    assert vector == list(corpus.where("id = '11'").first().embedding)
    with pytest.raises(ValueError, match="model"):
        load_corpus(spark, folder, "other")
    with pytest.raises(ValueError, match="components"):
        load_corpus(spark, folder, "hash-16", 32)
    with pytest.raises(Exception):
        load_corpus(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="have not 32"):
        save_corpus(corpus, str(tmp_path / "bad"), "m", "p", dimensions=32)
    gaps = corpus.withColumn("embedding", F.when(F.col("position") > 3, F.col("embedding")))
    with pytest.raises(ValueError, match="4 of 9"):
        save_corpus(gaps, str(tmp_path / "gaps"), "m", "p")
