"""A file cut by byte ranges equals the file read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.tree import flatten_tree
from shelfmark.sources.taxonomy import read_taxonomy, top_nodes
from shelfmark.sources.taxonomy_scan import scan_nodes


@pytest.fixture()
def small_ranges(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def node(rng, depth=0):
    odd = ['a "quoted" {name}', "back\\slash\\", "}{][,", 'x\\"}', "Zürich 🍞", '"Schema": [', "", "line\nend\t"]
    made = {"Code": rng.randrange(10**6), "Title": rng.choice(odd) * rng.randrange(1, 4), "Level": depth + 1,
            "Definition": rng.choice([None, *odd])}
    if depth < 3 and rng.random() < 0.8:
        made["Childs"] = [node(rng, depth + 1) for _ in range(rng.randrange(0, 4))]
    return made


def both(spark, path):
    def rows(df):
        return sorted((r.place, json.dumps(json.loads(r.text), sort_keys=True))
                      for r in df.select("place", F.to_json("node").alias("text")).collect())

    return rows(scan_nodes(spark, path)), rows(top_nodes(read_taxonomy(spark, path)))


@pytest.mark.parametrize("size", [40, 333, 5000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_equal_the_whole_file(spark, tmp_path, small_ranges, size, indent):
    rng = random.Random(size)
    nodes = [node(rng) for _ in range(12)]
    content = {"note": {"Schema": [1, {"x": "}"}], "text": "\"Schema\": ["}, "Schema": nodes, "after": [{"a": [1]}, "]"]}
    (tmp_path / "a.json").write_text(json.dumps(content, ensure_ascii=bool(indent), indent=indent), encoding="utf-8")
    small_ranges(size)
    scanned, whole = both(spark, str(tmp_path / "a.json"))
    assert scanned == whole and [p for p, _ in scanned] == list(range(12))
    assert [json.loads(t) for _, t in scanned] == nodes


@pytest.mark.parametrize("text, places", [
    ('{"Schema": []}', 0), ('{"Schema": [ ]}\n', 0), ('﻿{"Schema": [{"Code": 1}]}', 1), ('{"Schema": {"Code": 1, "Childs": [{"Code": 2}]}} \n', 1),
    ('{"Schema": [{"Code": 1},{"Code": 2}], "Other": {"Schema": [{"Code": 3}]}}', 2), ('{"a": "\\\\", "Schema": [{"Code": 1}]}', 1),
    ('{"Schema" : \n [ {"Code":1} , {"Code":2} , {} ] }', 3),
])
@pytest.mark.parametrize("size", [7, 1 << 20])
def test_forms(spark, tmp_path, small_ranges, text, places, size):
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    small_ranges(size)
    scanned, whole = both(spark, str(tmp_path / "a.json"))
    assert scanned == whole and len(scanned) == places


@pytest.mark.parametrize("text", [
    '{"Other": [{"Code": 1}]}', '{"Schema": [{"Code": 1}', '{"Schema": [{"Code": 1}]', '{"x": {"Schema": [{"Code": 1}]}}',
    '[{"Schema": [1]}]', '{"Schema": 7}', '{"Schema": [{"Code": "open}]}', "{}",
])
@pytest.mark.parametrize("size", [9, 1 << 20])
def test_files_without_schema_are_errors(spark, tmp_path, small_ranges, text, size):
    (tmp_path / "a.json").write_text(text)
    small_ranges(size)
    with pytest.raises(Exception, match="Schema"):
        scan_nodes(spark, str(tmp_path / "a.json")).collect()


def test_many_files_and_the_tree(spark, tmp_path, small_ranges):
    rng = random.Random(3)
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(json.dumps({"Schema": [node(rng) for _ in range(4)]}), encoding="utf-8")
    small_ranges(200)
    columns = ["id", "title", "hierarchy_string", "level", "text"]
    scanned = flatten_tree(scan_nodes(spark, str(tmp_path))).orderBy("position").select(columns).collect()
    whole = flatten_tree(top_nodes(read_taxonomy(spark, str(tmp_path)))).orderBy("position").select(columns).collect()
    assert scanned == whole and len(scanned) > 20


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    rng = random.Random(4)
    (tmp_path / "a.json").write_text(json.dumps({"Schema": [node(rng) for _ in range(40)]}), encoding="utf-8")
    small_ranges(1000)
    found = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json"))
    assert found.rdd.getNumPartitions() > 5
    with pytest.raises(Exception, match="(?i)malformed|parse|json"):
        (tmp_path / "b.json").write_text('{"Schema": [{"Code": oops}]}')
        scan_nodes(spark, str(tmp_path / "b.json")).collect()
