"""Tables updated in place: what changes, what keeps its files, and runs that broke off."""

import os

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.chat import first_option_provider
from shelfmark.operators.embedding import embed, hashing_provider
from shelfmark.plans.classify import classify, classify_in_place
from shelfmark.plans.embed_rows import embed_in_place
from shelfmark.sources import keyed
from shelfmark.sources.tables import apply_updates


def files(path):
    return {os.path.join(folder, name) for folder, _, names in os.walk(f"{path}/rows") for name in names
            if name.endswith(".parquet")}


def in_ranges(names, ranges):
    return {n for n in names if int(n.split("/part=")[1].split("/")[0]) in ranges}


def people(spark, n=1000):
    return spark.range(n).select(
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("k"), (F.col("id") % 7).alias("v"),
        F.when(F.col("id") % 5 == 0, F.col("id").cast("string")).alias("s"), F.array(F.col("id")).alias("a"))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_changed_ranges_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table = people(spark)
    keyed.create_keyed(table, path, "k", rows_per_range=100)
    assert rows(keyed.read_keyed(spark, path)) == rows(table) and keyed.read_keyed(spark, path).columns == table.columns
    before = files(path)
    assert {int(n.split("/part=")[1].split("/")[0]) for n in before} == set(range(10))
    updates = spark.createDataFrame([("k00005", 70, "x"), ("k00006", 71, None), ("k00950", 72, "y"), ("k00500x", 1, "z"),
                                     (None, 2, "n")], "k string, v bigint, s string")
    done = keyed.update_keyed(updates, path, ["v", "s"])
    assert (done.rows, done.ranges, len(done.rewritten)) == (3, 10, 2)
    after = files(path)
    kept = set(range(10)) - set(done.rewritten)
    assert in_ranges(after, kept) == in_ranges(before, kept)
    assert not in_ranges(after, done.rewritten) & in_ranges(before, done.rewritten)
    expected = apply_updates(table, updates.where("k IS NOT NULL"), "k", ["v", "s"])
    assert rows(keyed.read_keyed(spark, path)) == rows(expected)
    # No key met: nothing is written.
    assert keyed.update_keyed(updates.where("k = 'k00500x'"), path, ["v"]).rewritten == [] and files(path) == after
    assert keyed.update_keyed(updates.limit(0), path, ["v"]) == keyed.KeyedUpdate(0, 0, [], 10)


def test_only_null_keys_repeats_and_empty_tables(spark, tmp_path):
    table = spark.createDataFrame([(1, "a"), (1, None), (None, None), (2, None), (3, "c")], "id int, s string")
    path = str(tmp_path / "t")
    keyed.create_keyed(table, path, "id", rows_per_range=2)
    updates = spark.createDataFrame([(1, "x"), (3, "y")], "id int, s string")
    assert keyed.update_keyed(updates, path, ["s"], only_null=True).rows == 3
    found = keyed.read_keyed(spark, path)
    assert rows(found) == rows(spark.createDataFrame([(1, "a"), (1, "x"), (None, None), (2, None), (3, "c")], "id int, s string"))
    with pytest.raises(ValueError, match="repeat"):
        keyed.update_keyed(updates.union(updates), path, ["s"])
    with pytest.raises(ValueError, match="column other"):
        keyed.update_keyed(updates.withColumn("other", F.lit(1)), path, ["other"])
    with pytest.raises(ValueError, match="holds a keyed table"):
        keyed.create_keyed(table, path, "id")
    with pytest.raises(ValueError, match="part"):
        keyed.create_keyed(table.withColumn("part", F.lit(1)), str(tmp_path / "u"), "id")
    empty = keyed.create_keyed(table.limit(0), str(tmp_path / "e"), "id")
    assert empty.collect() == [] and empty.columns == ["id", "s"]
    assert keyed.update_keyed(updates, str(tmp_path / "e"), ["s"]).rewritten == []


@pytest.mark.parametrize("kind", ["date", "decimal(12,2)", "double", "timestamp"])
def test_kinds_of_keys(spark, tmp_path, kind):
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    key = day.cast(kind) if kind in ("date", "timestamp") else (F.col("id") / 4).cast(kind)
    table = spark.range(200).select(key.alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "t")
    keyed.create_keyed(table, path, "k", rows_per_range=30)
    done = keyed.update_keyed(table.where("v = 190").withColumn("v", F.lit(-1).cast("bigint")), path, ["v"])
    assert done.rows == 1 and len(done.rewritten) == 1 < done.ranges
    assert sorted(r.v for r in keyed.read_keyed(spark, path).collect()) == sorted([-1, *(i for i in range(200) if i != 190)])


def test_frequent_key(spark, tmp_path):
    """A third of all rows with one key do not take the bounds away from the others."""
    table = people(spark, 600).unionByName(people(spark, 300).withColumn("k", F.lit("k00100")))
    path = str(tmp_path / "t")
    keyed.create_keyed(table, path, "k", rows_per_range=100)
    done = keyed.update_keyed(spark.createDataFrame([("k00100", 9)], "k string, v bigint"), path, ["v"])
    assert done.rows == 301 and len(done.rewritten) == 1 and done.ranges == 9
    assert keyed.read_keyed(spark, path).where("k = 'k00100' AND v = 9").count() == 301


def test_update_that_broke_off_goes_on(spark, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "t"), str(tmp_path / "run")
    table = people(spark, 300)
    keyed.create_keyed(table, path, "k", rows_per_range=50)
    updates = table.where("v = 3").select("k", F.lit("new").alias("s"))
    expected = rows(apply_updates(table, updates, "k", ["s"]))
    joined = keyed.apply_updates

    def broken(*args):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(keyed, "apply_updates", broken)
    with pytest.raises(RuntimeError, match="lost"):
        keyed.update_keyed(updates, path, ["s"], folder=folder)
    assert rows(keyed.read_keyed(spark, path)) == rows(table)
    monkeypatch.setattr(keyed, "apply_updates", joined)
    with pytest.raises(ValueError, match="other settings"):
        keyed.update_keyed(updates.limit(3), path, ["s"], folder=folder, resume=True)
    keyed.update_keyed(updates, path, ["s"], folder=folder, resume=True)
    assert rows(keyed.read_keyed(spark, path)) == expected
    # The last step may break off half way: half of the new files are there, the rest is replaced again.
    for name in sorted(files(path))[::2]:
        os.remove(name)
    monkeypatch.setattr(keyed, "apply_updates", broken)
    keyed.update_keyed(updates, path, ["s"], folder=folder, resume=True)
    assert rows(keyed.read_keyed(spark, path)) == expected


def test_plan_reads_only_touched_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.create_keyed(people(spark, 300), path, "k", rows_per_range=50)
    part = keyed.read_keyed(spark, path, [1, 2])
    assert part.count() == 100
    assert "PartitionFilters: [part" in part._jdf.queryExecution().executedPlan().toString()


def test_embedding_in_place(spark, tmp_path):
    table = spark.range(400).select("id", F.concat(F.lit("row "), "id").alias("name"), F.when(
        (F.col("id") < 180) | (F.col("id") >= 220), "[1]").alias("embedding_context"))
    path = str(tmp_path / "t")
    keyed.create_keyed(table, path, "id", rows_per_range=50)
    before = files(path)
    done = embed_in_place(spark, path, "id", ["name"], hashing_provider(4), 4)
    assert done.updates == done.rows == 40 and done.rewritten == [3, 4]
    assert in_ranges(files(path), {0, 1, 2, 5, 6, 7}) == in_ranges(before, {0, 1, 2, 5, 6, 7})
    found = keyed.read_keyed(spark, path)
    assert found.where("embedding_context IS NULL").isEmpty() and found.where("embedding_context = '[1]'").count() == 360
    again = embed_in_place(spark, path, "id", ["name"], hashing_provider(4), 4)
    assert again.updates == 0 and again.rewritten == []


def test_classification_in_place(spark, tmp_path):
    paths = [["Food", "Bread"], ["Toys", "Chess"], ["Food", "Cake"]]
    corpus = spark.createDataFrame(
        [(i, str(i), p, " ".join(p)) for i, p in enumerate(paths)], "position bigint, id string, hierarchy_path array<string>, text string"
    ).withColumn("embedding", embed(F.col("text"), hashing_provider(16))).drop("text")
    targets = ["segment", "family"]
    table = spark.range(120).select(
        "id", F.when(F.col("id") % 2 == 0, "Food Bread").otherwise("Toys Chess").alias("name"),
        F.when(F.col("id") < 60, "done").alias("segment"), F.lit(None).cast("string").alias("family"))
    table = table.withColumn("embedding_context", F.to_json(embed(F.col("name"), hashing_provider(16))))
    path = str(tmp_path / "t")
    stored = keyed.create_keyed(table, path, "id", rows_per_range=20)
    options = {"prompt_columns": ["name"], "dimensions": 16}
    expected = rows(classify(stored, corpus, "id", first_option_provider(), targets=targets, **options).table)
    before = files(path)
    run, done = classify_in_place(spark, path, corpus, "id", first_option_provider(), targets, **options)
    assert rows(run.table) == expected and done.rows == 60 and done.rewritten == [3, 4, 5]
    assert in_ranges(files(path), {0, 1, 2}) == in_ranges(before, {0, 1, 2})
    assert tuple(run.summary.first()) == (60, 0, 60, 6) and run.refused.isEmpty() and run.unresolved.isEmpty()
