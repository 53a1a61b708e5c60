import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import chat, prompts
from shelfmark.operators.numbering import assign_batches, in_batches, key_problems, number_rows, range_of

PRODUCT = (
    "batch bigint, id bigint, context array<struct<key:string,value:string>>, candidates array<struct<letter:string,"
    "hierarchy_string:string,attributes:array<struct<level:int,code:string,title:string>>>>"
)
BREAD = [
    ("A", "Food > Bakery > Bread > Wholemeal Bread", [(5, "50000001", "Pre-sliced Brown Bread"), (6, "6", "Yes")]),
    ("B", "NONE", []),
]


def message(spark, rows, plain=False):
    df = spark.createDataFrame(rows, PRODUCT)
    make = prompts.plain_product_block if plain else prompts.product_block
    block = make(F.col("id").cast("string"), F.col("context"), F.col("candidates"))
    return prompts.batch_prompts(df.select("batch", "id", block.alias("block")), "id", plain=plain)


def test_exact_text(spark):
    rows = [
        (1, 102, [("product_name", "Milk")], []),
        (1, 101, [("product_name", "Whole grain bread"), ("brand", ""), ("weight_g", "400")], BREAD),
    ]
    row = message(spark, rows).first()
    assert row.products == 2
    assert row.user_message == (
        "Classify the following 2 product(s) into GS1 GPC categories.\n\n"
        "\n--- Product 101 ---\nproduct_name: Whole grain bread\nweight_g: 400\n\nCandidate categories:\n"
        "[A] Food > Bakery > Bread > Wholemeal Bread | Pre-sliced Brown Bread, Yes\n[B] NONE\n\n"
        "\n--- Product 102 ---\nproduct_name: Milk\n\nCandidate categories:\n\n"
        '\nRespond with a JSON object containing a "results" key:\n'
        '{"results": [{"product_id": <id>, "choice": "<letter>"}, ...]}'
    )
    assert row.system_message.startswith("You are a product classification assistant. Your job")


def test_plain_text_has_safe_sorted_json(spark):
    value = "Käse <b> & 'x' \"q\" \U0001f600\n"
    row = message(spark, [(1, 7, [("z", value), ("a", "")], BREAD)], plain=True).first()
    line = row.user_message.splitlines()[3]
    assert json.loads(line) == {"a": "", "z": value} and line.isascii() and line.startswith('{"a": ')
    assert not set("<>&'") & set(line) and "\\u003cb\\u003e \\u0026 \\u0027x\\u0027" in line
    assert row.user_message == (
        f"Classify these products into GS1 GPC categories.\n\n--- Product 7 ---\n{line}\n\nCandidates:\n"
        "[A] Food > Bakery > Bread > Wholemeal Bread\n[B] NONE\n\n"
        'Respond with: {"results": [{"product_id": <id>, "choice": "<letter>"}]}'
    )


def test_batches(spark):
    def sizes(n, size):
        keys = spark.range(n).select((F.col("id") * 37 % 1009).alias("k")).repartition(5)
        rows = assign_batches(keys, "k", size).orderBy("k").collect()
        assert [r.batch for r in rows] == [i // size + 1 for i in range(n)]
        return len({r.batch for r in rows})

    assert (sizes(10, 3), sizes(6, 3), sizes(0, 3), sizes(1000, 7)) == (4, 2, 0, 143)


@pytest.mark.parametrize("n, size, partitions", [(0, 10, 4), (1, 10, 4), (95, 10, 4), (1000, 7, 8), (64, 1, 5), (30, 100, 3)])
def test_batches_lie_within_partitions(spark, n, size, partitions):
    rows = spark.range(n).select((F.col("id") * 37 % 1009).alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartition(6)
    placed = in_batches(rows, rows.select("k"), "k", size, partitions=partitions)
    found = placed.withColumn("task", F.spark_partition_id()).orderBy("k").collect()
    assert [r.batch for r in found] == [i // size + 1 for i in range(n)]
    assert len({(r.batch, r.task) for r in found}) == len({r.batch for r in found})
    assert {r.part for r in found} <= set(range(partitions)) and sorted(r.v for r in found) == sorted(f"v{i}" for i in range(n))
    plan = placed.groupBy("part", "batch").agg(F.collect_list("v"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_batches_leave_out_keys_that_tell_no_rows_apart(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",), ("d",), (None,), ("",)], "k string").repartition(3)
    found = in_batches(rows, rows, "k", 2, partitions=2).orderBy("k").collect()
    assert [(r.k, r.batch) for r in found] == [("", 1), ("a", 1), ("b", 2), ("d", 2)]
    odd = {r.k: (r.rows, r.problem) for r in key_problems(rows, "k").collect()}
    assert odd == {None: (2, "no key"), "c": (2, "repeated key")}


def test_range_of(spark):
    rows = spark.range(50).select("id", range_of(F.col("id"), [3, 10, 11, 40]).alias("r")).collect()
    assert [r.r for r in rows] == [sum(b <= r.id for b in (3, 10, 11, 40)) for r in rows]
    assert spark.range(2).select(range_of(F.col("id"), [])).distinct().collect() == [(0,)]


def test_numbers_follow_any_order(spark):
    df = spark.range(500).select(
        F.concat(F.lit("k"), (F.col("id") * 7 % 500).cast("string")).alias("name"), F.array(F.col("id") % 9, F.col("id")).alias("place")
    )
    for order in (["name"], ["place"], ["place", "name"]):
        rows = number_rows(df, order, "n", partitions=7).collect()
        expected = sorted(rows, key=lambda r: tuple(r[c] for c in order))
        assert [r.n for r in expected] == list(range(500))


def test_chat_errors_stay_in_their_row(spark):
    def provider():
        def call(system, user):
            if "bad" in user:
                raise RuntimeError("no answer")
            return {"content": user.upper(), "usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 3}}
        return call

    asked = spark.createDataFrame([(1, "s", "ok"), (2, "s", "bad")], "batch bigint, system_message string, user_message string")
    rows = {r.batch: r for r in chat.complete(asked, provider).collect()}
    assert (rows[1].content, rows[1].total_tokens, rows[1].error) == ("OK", 3, None)
    assert (rows[2].content, rows[2].error) == (None, "no answer")
    usage = chat.token_usage(chat.complete(asked, provider)).first()
    assert tuple(usage) == (2, 1, 2, 3)


def test_one_call_per_prompt_even_when_filtered(spark, tmp_path):
    calls = str(tmp_path)

    def provider():
        def call(system, user):
            with open(f"{calls}/{user}", "a") as log:
                log.write("x")
            return {"content": user, "usage": {}}
        return call

    asked = spark.range(20).select(
        F.col("id").alias("batch"), F.lit("s").alias("system_message"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_message")
    )
    answered = chat.complete(asked, provider).where("error IS NULL AND length(content) > 0")
    answered.select("batch", F.explode(F.split("content", ""))).count()
    assert all((tmp_path / f"u{i}").read_text() == "x" for i in range(20))


def test_prompts_are_read_a_few_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from shelfmark.operators import chat

    made, real = [], chat.F.arrow_udf
    monkeypatch.setattr(chat.F, "arrow_udf", lambda kind: lambda function: (made.append(function), real(kind)(function))[1])
    prompts = spark.createDataFrame([(1, "s", "u")], "batch int, system_message string, user_message string")
    chat.complete(prompts, lambda: lambda system, user: {"content": user})
    users = pa.array([f"u{i}" for i in range(1000)])
    parts = list(made[0](iter([(pa.array(["s"] * 1000), users), (users[:0], users[:0])])))
    assert max(map(len, parts)) <= 64
    assert [row["content"] for part in parts for row in part.to_pylist()] == users.to_pylist()
