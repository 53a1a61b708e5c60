import duckdb
import pytest
from pyspark.sql import functions as F

from shelfmark.functions.vectors import with_vector
from shelfmark.operators import reports
from shelfmark.sources import tables as tb


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([(1, "a", None), (2, "b", "old"), (3, "c", None)], "id int, name string, seg string")


def test_updates(spark, table):
    updates = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (2, "z", 0), (9, "n", 0), (3, None, 0)], "id int, seg string, n int")
    last = tb.last_update(updates, "id", ["n"]).drop("n")
    assert {r.id: r.seg for r in last.collect()} == {1: "y", 2: "z", 9: "n", 3: None}
    done = tb.apply_updates(table, last, "id", ["seg"])
    assert done.columns == table.columns
    assert {tuple(r) for r in done.collect()} == {(1, "a", "y"), (2, "b", "z"), (3, "c", None)}
    kept = tb.apply_updates(table, last, "id", ["seg"], only_null=True)
    assert {tuple(r) for r in kept.collect()} == {(1, "a", "y"), (2, "b", "old"), (3, "c", None)}
    assert tb.apply_updates(table, last.limit(0), "id", ["seg"]).exceptAll(table).isEmpty()


def test_last_update_reduces_a_hot_key_before_the_shuffle(spark):
    updates = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"), F.col("id").alias("v")
    )
    last = tb.last_update(updates, "k", ["n"])
    assert last.where("k = -1").first().v == 29_997
    assert "partial_max_by" in last._jdf.queryExecution().executedPlan().toString()


def test_snapshot_never_overwrites_its_input(spark, table, tmp_path):
    first = tb.write_snapshot(table, f"{tmp_path}/v1")
    with pytest.raises(ValueError):
        tb.write_snapshot(first.where("id > 1"), f"{tmp_path}/v1")
    assert tb.write_snapshot(first.where("id > 1"), f"{tmp_path}/v2").count() == 2


def test_pending_reads_only_what_it_needs(spark, table, tmp_path):
    stored = tb.write_snapshot(table, f"{tmp_path}/t")
    pending = tb.pending_rows(stored, "seg", ["id"])
    text = pending._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(seg)" in text and "ReadSchema: struct<id:int,seg:string>" in text
    assert tb.pending_count(stored, "seg").first().remaining == 2
    assert [r.id for r in tb.page_of_rows(stored, "id", 1, 1).collect()] == [2]
    assert tb.read_table(spark, f"{tmp_path}/t", ["name"]).columns == ["name"]


def test_parameterised_sql(spark, table):
    rows = tb.run_sql(spark, "SELECT id FROM {t} WHERE name = :n", {"n": "b"}, t=table).collect()
    assert [r.id for r in rows] == [2]


def test_jdbc_options():
    options = tb.jdbc_options("jdbc:x", "s.t", user="u", fetch_rows=5)
    assert options == {"url": "jdbc:x", "dbtable": "s.t", "fetchsize": "5", "user": "u"}


def _starts(table, key, partitions):
    rows = duckdb.sql(tb.range_starts_query(table, key, partitions)).fetchall()
    return [low for _, low in sorted(rows, key=lambda r: r[0])]


@pytest.mark.parametrize("key", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
def test_ranges_hold_every_row_once_and_are_even(folder, key):
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW orders_read AS SELECT * FROM '{folder}/orders.parquet'")
    conditions = tb.range_conditions(key, _starts("orders_read", key, 8))
    sizes = [duckdb.sql(f"SELECT count(*) FROM orders_read WHERE {c}").fetchall()[0][0] for c in conditions]
    rows, most = duckdb.sql(f"SELECT sum(n), max(n) FROM (SELECT {key}, count(*) AS n FROM orders_read GROUP BY 1)").fetchall()[0]
    assert sum(sizes) == rows and max(sizes) <= rows / 8 + 1 + most


def test_ranges_of_odd_keys():
    duckdb.sql("CREATE OR REPLACE TEMP VIEW odd AS SELECT CASE WHEN i < 500 THEN 7 WHEN i < 520 THEN NULL ELSE i * i END AS k "
               "FROM range(1000) t(i)")
    conditions = tb.range_conditions("k", _starts("odd", "k", 8))
    sizes = [duckdb.sql(f"SELECT count(*) FROM odd WHERE {c}").fetchall()[0][0] for c in conditions]
    # The key of 500 rows fills four parts of 122 or 123 and begins the fifth; they are one range, with the 20 NULLs.
    assert sum(sizes) == 1000 and len(sizes) == 4 and sizes[0] <= 5 * 123 + 20 and max(sizes[1:]) <= 123
    assert tb.range_conditions("k", []) == tb.range_conditions("k", [4, 4]) == ["1 = 1"]
    assert tb.range_conditions("k", ["a", "o'b"]) == ["k < 'o''b' OR k IS NULL", "k >= 'o''b'"]


def test_even_scan_asks_for_starts_first():
    """Without a database: what Spark is asked to read."""
    class Reader:
        asked = {}

        def format(self, name):
            return self

        def options(self, **options):
            self.asked["options"] = options
            return self

        def load(self):
            return self

        def collect(self):
            return [(2, 10), (1, 3), (3, 10)]

        def jdbc(self, url, table, predicates, properties):
            self.asked |= {"table": table, "predicates": predicates, "properties": properties}
            return self

        def select(self, *columns):
            return columns

    class Session:
        read = Reader()

    assert tb.read_jdbc_evenly(Session(), "jdbc:x", "s.t", ["id", "name"], "id", 3, user="u") == ("id", "name")
    assert Reader.asked["options"]["query"] == tb.range_starts_query("s.t", "id", 3) and "dbtable" not in Reader.asked["options"]
    assert Reader.asked["table"] == "s.t" and Reader.asked["predicates"] == ["id < 10 OR id IS NULL", "id >= 10"]
    assert Reader.asked["properties"] == {"fetchsize": "10000", "user": "u"}


def test_merge_statement():
    assert tb.merge_statement("p.t", "p.s", "id", ["gs1_segment", "embedding_context"], 1024) == (
        "MERGE INTO p.t AS t USING p.s AS s ON t.id = s.id WHEN MATCHED THEN UPDATE SET gs1_segment = s.gs1_segment, "
        "embedding_context = CAST(CAST(s.embedding_context AS VARCHAR(MAX)) AS VECTOR(1024));"
    )
    assert "CAST(s.embedding_context AS vector(8))" in tb.merge_statement(
        "t", "s", "id", ["embedding_context"], 8, "postgresql"
    )


def test_merge_needs_a_table_format_that_can(spark, table):
    spark.sql("DROP TABLE IF EXISTS merge_target")
    table.write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(Exception, match="(?i)merge"):
        tb.merge_into_table(table.withColumn("seg", F.lit("n")), "merge_target", "id", ["seg"])
    spark.sql("DROP TABLE merge_target")


def test_vector_column_states(spark):
    df = spark.createDataFrame(
        [(0, "[1, 2]"), (1, None), (2, "oops"), (3, "[1]"), (4, '[1, null]'), (5, "[1, 2] x"), (6, ""), (7, " [1.5, -2e1] "),
         (8, '{"a": 1}'), (9, "7")],
        "id int, v string",
    )
    rows = {r.id: (r.vector_status, r.vector) for r in with_vector(df, "v", 2).collect()}
    assert rows[0] == ("ok", [1.0, 2.0]) and rows[7] == ("ok", [1.5, -20.0])
    assert rows[1] == ("skipped", None)
    assert all(rows[i] == ("failed", None) for i in (2, 3, 4, 5, 6, 8, 9))
    arrays = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [1.0])], "id int, v array<double>")
    assert [r.vector_status for r in with_vector(arrays, "v", 2).orderBy("id").collect()] == ["ok", "skipped", "failed"]
    assert with_vector(spark.range(1), "id").first().vector_status == "skipped"


def test_category_counts(spark):
    labels = ["b", "a", "a", "", "c", "d", "e", "f", "Health & Beauty"]
    results = spark.createDataFrame([(1, i, x) for i, x in enumerate(labels)] + [(2, 0, "z")], "batch int, ordinal int, seg string")
    rows = [tuple(r) for r in reports.category_counts(results, "seg").orderBy("batch", "rank").collect()]
    assert rows == [(1, 1, "a", 2, 3), (1, 2, "b", 1, 3), (1, 3, "c", 1, 3), (1, 4, "d", 1, 3), (2, 1, "z", 1, 0)]


def test_failure_log(spark, tmp_path):
    failures = spark.createDataFrame([(1, 2, "e")], "product_id int, batch bigint, error string")
    assert not reports.write_failures(failures.limit(0), f"{tmp_path}/none") and not (tmp_path / "none").exists()
    assert reports.write_failures(failures, f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").first().error == "e"
