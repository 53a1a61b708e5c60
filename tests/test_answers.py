import json
import random
import re

import pytest

from shelfmark.fixed import UNPARSEABLE
from shelfmark.operators import answers as an

CANDIDATE = (
    "array<struct<letter:string,hierarchy_path:array<string>,hierarchy_string:string,score:double,"
    "attributes:array<struct<level:int,code:string,title:string>>>>"
)
TARGETS = ["c1", "c2", "c3", "c4", "c5", "c6"]
BREAD = ("A", ["Food", "Bakery", "Bread", "White Bread"], "Food > Bakery > Bread > White Bread", 0.1, [])
NONE = ("B", [], "NONE", 0.2, [])


def parse(spark, *contents):
    rows = spark.createDataFrame(list(enumerate(contents)), "batch bigint, content string")
    return [
        (r.error, None if r.answers is None else [(a.id_key, a.choice) for a in r.answers])
        for r in an.parse_responses(rows).orderBy("batch").collect()
    ]


@pytest.mark.parametrize("content, answers", [
    ('{"results": [{"product_id": 42, "choice": "A"}]}', [("n:42", "A")]),
    ('Here is my answer: [{"product_id": 1, "choice": "A"}] Hope that helps!', [("n:1", "A")]),
    ('[{"product_id": 1, "choice": " b "}]', [("n:1", "B")]),
    ('{"a": 1, "first": [], "results": [{"product_id": 1, "choice": "A"}]}', []),
    ('{"results": []}', []),
    ('{"results": [{"product_id": 1}]}', [("n:1", "")]),
    ('{"results": [{"product_id": "8", "choice": "A"}, {"product_id": 8.0, "choice": "A"}]}', [("s:8", "A"), ("n:8", "A")]),
    ('[{"product_id": true, "choice": "A"}, {"choice": "C"}]', [("n:1", "A"), (None, "C")]),
    ('{"x": {"y": [{"product_id": 3, "choice": "A"}]}}', [("n:3", "A")]),
    ('{"results": [1], "results": [{"product_id": 3, "choice": "A"}]}', [("n:3", "A")]),
    ('```json\n[{"product_id": 5,\n "choice": "A"}]\n```', [("n:5", "A")]),
    ('{"results": [{"product_id": 5, "choice": "A"}]} trailing', [("n:5", "A")]),
])
def test_readable_responses(spark, content, answers):
    assert parse(spark, content) == [(None, answers)]


@pytest.mark.parametrize("content", [
    "This is not JSON or any list", "", "{}", "null", "3", '{"results": "A"}', "see [1] and [2]",
    '{"results": [{"product_id": 5, "choice": "A"}]} [done]', "[1, 2",
])
def test_unreadable_responses(spark, content):
    assert parse(spark, content) == [(UNPARSEABLE, None)]


@pytest.mark.parametrize("content", [
    '[{"product_id": 1, "choice": "A"}, {"product_id": 2, "choice": null}]', '[{"product_id": 1, "choice": 3}]',
    '["A"]', "[[]]", '[{"product_id": [1], "choice": "A"}]', '{"results": [null]}',
])
def test_bad_answer_fails_the_response(spark, content):
    error, answers = parse(spark, content)[0]
    assert error and error != UNPARSEABLE and answers is None


def test_missing_content_and_earlier_error(spark):
    assert parse(spark, None)[0][0]
    rows = spark.createDataFrame([(1, "[]", "timeout")], "batch bigint, content string, error string")
    row = an.parse_responses(rows).first()
    assert (row.error, row.answers) == ("timeout", None)


def match(spark, responses, products, coerce=False, kind="bigint"):
    parsed = an.parse_responses(spark.createDataFrame(responses, "batch bigint, content string"))
    table = spark.createDataFrame(products, f"batch bigint, id {kind}, candidates {CANDIDATE}")
    return an.match_answers(an.answer_rows(parsed), table, "id", coerce_ids=coerce)


def test_choices_become_columns(spark):
    found = match(
        spark,
        [(1, '[{"product_id": 42, "choice": "a"}, {"product_id": 42, "choice": "Q"}, {"product_id": 7, "choice": "A"}]'),
         (2, '[{"product_id": 42, "choice": "A"}]')],
        [(1, 42, [BREAD, NONE]), (2, 7, [BREAD])],
    )
    results = an.matched_results(found, "id", targets=TARGETS).collect()
    assert [tuple(r) for r in results] == [(1, 0, 42, "Food", "Bakery", "Bread", "White Bread", "", "")]
    lost = {(r.batch, r.ordinal, r.choice) for r in an.unmatched_answers(found).collect()}
    # A letter not offered, and products that belong to the other batch.
    assert lost == {(1, 1, "Q"), (1, 2, "A"), (2, 0, "A")}


def test_ids_are_compared_with_their_type(spark):
    responses = [(1, '[{"product_id": "8", "choice": "A"}]')]
    products = [(1, 8, [BREAD])]
    assert match(spark, responses, products).where("candidate IS NOT NULL").count() == 0
    assert match(spark, responses, products, coerce=True).where("candidate IS NOT NULL").count() == 1
    texts = [(1, "8", [BREAD])]
    assert match(spark, responses, texts, kind="string").where("candidate IS NOT NULL").count() == 1
    floats = [(1, 8.0, [BREAD])]
    numbers = [(1, '[{"product_id": 8, "choice": "A"}]')]
    assert match(spark, numbers, floats, kind="double").where("candidate IS NOT NULL").count() == 1


def test_random_texts_match_a_plain_model(spark):
    rng = random.Random(11)
    items = ['{"product_id": 1, "choice": "A"}', '{"product_id": 2}', '{"product_id": 3, "choice": null}', '"x"']

    def some_list():
        return "[" + ", ".join(rng.choices(items, [6, 2, 1, 1], k=rng.randint(0, 3))) + "]"

    def some_text():
        body = rng.choice([some_list(), '{"results": %s}' % some_list(), '{"a": 1, "b": %s, "c": %s}' % (some_list(), some_list())])
        return rng.choice(["", "", "Answer: ", "[1] ", "{"]) + body + rng.choice(["", "", "\n", " done", " ]", "}"])

    texts = [some_text() for _ in range(400)]

    def model(text):
        def load(part):
            try:
                return json.loads(part)
            except ValueError:
                return None

        value = load(text)
        lists = [v for v in value.values() if isinstance(v, list)] if isinstance(value, dict) else [value]
        if not lists or not isinstance(lists[0], list):
            block = re.search(r"\[(.|\n)*\]", text)
            lists = [load(block.group(0)) if block else None]
        if lists[0] is None:
            return "unreadable"
        good = all(isinstance(i, dict) and isinstance(i.get("choice", ""), str) for i in lists[0])
        return len(lists[0]) if good else "bad"

    found = ["unreadable" if e == UNPARSEABLE else "bad" if e else len(a) for e, a in parse(spark, *texts)]
    assert found == [model(t) for t in texts]
    assert len({str(f) for f in found}) >= 4
