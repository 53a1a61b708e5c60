import random
import struct

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text as tx


def test_float_text_is_python_repr(spark):
    rng = random.Random(1)
    values = [1e7, 123456789.125, 1e15, 1e16, 1.5e16, 1e-4, 9.99e-5, 5e-4, 0.1, -2.5e10, 1e22, 1e100, 1.5e-10, 3.0, -0.5]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-8, 20) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", tx.float_text(F.col("v")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.v) for r in rows]


def test_empty_values_become_empty_text(spark):
    df = spark.createDataFrame(
        [("a", 1, 2.5, True), ("", 0, 0.0, False), (None, None, None, None), ("b", -3, float("nan"), True)],
        "s string, i int, d double, b boolean",
    )
    rows = [tuple(r) for r in df.select(*[tx.filled_text(df, c) for c in df.columns]).collect()]
    assert rows == [("a", "1", "2.5", "True"), ("", "", "", ""), ("", "", "", ""), ("b", "-3", "", "True")]
    assert df.select(tx.row_text(df, ["s", "i", "d"], " * ").alias("t")).collect()[1].t == " *  * "


def test_row_text_example(spark):
    values = ("SuperStore", "DE", "Bio Tomaten", "Organic Tomatoes", "Fresh Produce", "Punnet", "500", "g")
    df = spark.createDataFrame([values], [f"c{i}" for i in range(len(values))])
    assert df.select(tx.row_text(df, df.columns)).first()[0] == (
        "SuperStore * DE * Bio Tomaten * Organic Tomatoes * Fresh Produce * Punnet * 500 * g"
    )


def test_strip_removes_all_white_space(spark):
    texts = ["  a b\t\n", " x ", "\x1cy\x1f", "", " \r\n ", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.strip(F.col("t"))).collect()
    assert [r[0] for r in rows] == [t.strip() for t in texts]


@pytest.mark.parametrize("identifier", ["7", "007", "+7", " 7 ", "-0", "-07", "1_000", "abc", "", "7.0", "1__0", "9" * 60])
def test_lookup_key_follows_whole_numbers(spark, identifier):
    try:
        expected = str(int(identifier))
    except ValueError:
        expected = identifier
    found = spark.createDataFrame([(identifier,)], "i string").select(tx.lookup_key(F.col("i"))).first()[0]
    assert found == expected


def test_letters(spark):
    rows = spark.range(30).select(tx.option_letter(F.col("id").cast("int")).alias("l")).collect()
    assert [r.l for r in rows] == [chr(65 + i) for i in range(26)] + ["Z26", "Z27", "Z28", "Z29"]


def test_node_text_and_names(spark):
    df = spark.createDataFrame([("A > B", "d", "e", 1), ("A", "", "", 6), ("A", "", "e", 7)], "p string, d string, e string, l int")
    rows = df.select(tx.node_text(F.col("p"), F.col("d"), F.col("e")), tx.level_name(F.col("l"))).collect()
    assert [tuple(r) for r in rows] == [
        ("A > B | d | Excludes: e", "Segment"), ("A", "AttributeValue"), ("A | Excludes: e", None),
    ]


def test_short_labels(spark):
    label = "Beverages - Alcoholic / Health & Beauty"
    assert spark.range(1).select(tx.short_label(F.lit(label))).first()[0] == "Alc. Bev. / H&B"


def test_answer_keys_compare_numbers_by_value(spark):
    df = spark.createDataFrame([(8, 8.0, "8", True)], "i bigint, d double, s string, b boolean")
    df = df.withColumn("dec", F.lit("8.00").cast("decimal(10,2)"))
    keys = df.select(*[tx.answer_key(df, c).alias(c) for c in df.columns]).first()
    assert (keys.i, keys.d, keys.dec, keys.s, keys.b) == ("n:8", "n:8", "n:8", "s:8", "n:1")
    assert df.select(tx.answer_key(df, "i", coerce=True)).first()[0] == "8"


def test_single_precision_context(spark):
    value = struct.unpack("f", struct.pack("f", 2.5))[0]
    df = spark.createDataFrame([(value,)], "v float")
    entry = df.select(tx.context_entries(df, ["v"]).alias("c")).first().c[0]
    assert (entry.key, entry.value) == ("v", "2.5")
