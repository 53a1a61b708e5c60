"""Exact deduplication by a stream with keyed state on disk.

Digests of documents go to an inbox folder. A Structured Streaming query reads
what is new there and keeps, for every digest, the row that stays and the size
of the group, in a RocksDB state store whose snapshots lie in the shared
folder. The state has no watermark and never expires, so a text that comes
back after any time is still recognised. The state is read as a table, and
every hit is compared byte for byte with the text that the state points to.

Only DataFrame functions run on the executors.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import lower_ascii, mark_possible, new_folder, plain_names, stored, without_rows

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
    # Many small stores: do not reserve disk for each of them in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
INBOX = "doc_id bigint, feed bigint, row bigint, digest string, bytes bigint"


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class DedupState:
    """A dedup state in ``folder``: ``feed`` documents, then ask for ``verdicts``.

    Feeding again, in this or a later session, goes on with the same state.

    * Texts are equal when identical after lower-casing A-Z; null counts as empty.
    * The row with the largest ``doc_id`` stays (null ids come before all others);
      of rows that repeat id and text exactly one stays.
    * Extra columns are ignored; an empty table gives no rows.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None,
                 digest: Callable[[Column], Column] = sha256_hex, files_per_batch: int = 1000):
        self.spark, self.digest, self.files_per_batch = spark, digest, files_per_batch
        self.folder = folder or new_folder(spark, "dedup")

    def _digests(self, docs: DataFrame) -> DataFrame:
        text = lower_ascii(F.col("text"))
        return docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.lit(time.time_ns()).alias("feed"),
            F.monotonically_increasing_id().alias("row"),
            self.digest(text).alias("digest"),
            F.octet_length(text).cast("bigint").alias("bytes"),
        )

    def feed(self, docs: DataFrame) -> None:
        """Add documents and bring the state up to date."""
        self._digests(docs).write.mode("append").parquet(f"{self.folder}/inbox")
        before = {name: self.spark.conf.get(name, None) for name in _SETTINGS}
        for name, value in _SETTINGS.items():
            self.spark.conf.set(name, value)
        try:
            arriving = self.spark.readStream.schema(INBOX).option("maxFilesPerTrigger", self.files_per_batch).parquet(
                f"{self.folder}/inbox")
            # The locator of the content is the id with its feed and row number; the largest one stays.
            groups = arriving.groupBy("digest").agg(
                F.max(F.struct("doc_id", "feed", "row", "bytes")).alias("stays"), F.count(F.lit(1)).alias("group_size"))
            query = groups.writeStream.format("noop").outputMode("update").trigger(availableNow=True).option(
                "checkpointLocation", f"{self.folder}/state").start()
            query.awaitTermination()
        finally:
            for name, value in before.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)

    def state(self) -> DataFrame:
        """The state as a table: digest, keep_id, keep_feed, keep_row, keep_bytes, group_size."""
        table = self.spark.read.format("statestore").load(f"{self.folder}/state")
        largest, size = (F.col(f"value.`{f.name}`") for f in table.schema["value"].dataType.fields)
        return table.select(
            F.col("key.digest").alias("digest"), largest["doc_id"].alias("keep_id"), largest["feed"].alias("keep_feed"),
            largest["row"].alias("keep_row"), largest["bytes"].alias("keep_bytes"), size.alias("group_size"))

    def rows(self) -> DataFrame:
        return self.spark.read.schema(INBOX).parquet(f"{self.folder}/inbox")

    def verdicts(self, docs: DataFrame) -> DataFrame:
        """One row per fed document: doc_id, keep_id, group_size, kept, text_sha256.

        ``docs`` are the documents that were fed; hits are checked against their
        full bytes. A digest that two different texts share is not decided by
        the state but by grouping its texts themselves.
        """
        rows, state = self.rows(), self.state()
        judged = rows.join(state, "digest").select(
            "doc_id", "digest", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("feed") == F.col("keep_feed"))
             & (F.col("row") == F.col("keep_row"))).alias("kept"))
        clashing = stored(self._clashes(docs, state), "clashes")
        if not clashing.isEmpty():
            judged = judged.join(clashing, "digest", "left_anti").unionByName(self._by_text(docs, clashing))
        return judged.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))

    def _clashes(self, docs: DataFrame, state: DataFrame) -> DataFrame:
        """Digests with hits whose full texts are not all the same.

        Only texts whose digest is possibly a repeated one are looked at, by
        bitmaps sized from the number of such digests. The smallest and the
        largest text of a digest are found within tasks first, so a text that a
        third of all rows share is one row a task.
        """
        repeated = state.where(F.col("group_size") > 1).select(F.xxhash64("digest").alias("hash"))
        text = lower_ascii(F.col("text"))
        texts = docs.select(self.digest(text).alias("digest"), text.alias("text"))
        hits = mark_possible(texts, F.xxhash64("digest"), stored(repeated, "repeated-digests"), "possible").where("possible")
        ends = hits.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most"))
        return ends.where(F.col("least") != F.col("most")).select("digest")

    def _by_text(self, docs: DataFrame, clashing: DataFrame) -> DataFrame:
        from pyspark.sql import Window

        text = lower_ascii(F.col("text"))
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), self.digest(text).alias("digest"),
                            text.alias("text")).join(clashing, "digest")
        group = Window.partitionBy("digest", "text")
        ranked = texts.withColumn("place", F.row_number().over(group.orderBy(F.desc("doc_id"))))
        return ranked.select("doc_id", "digest", F.max("doc_id").over(group).alias("keep_id"),
                             F.count(F.lit(1)).over(group).alias("group_size"), (F.col("place") == 1).alias("kept"))


def exact_dedup(docs: DataFrame, files_per_batch: int = 1000) -> DataFrame:
    """Verdict per document, over a state of its own."""
    state = DedupState(docs.sparkSession, files_per_batch=files_per_batch)
    state.feed(docs)
    return state.verdicts(docs)


def keep_first_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps, of copies the one with the largest ``doc_id``.

    Null texts count as empty and null ids as the smallest; of rows that repeat
    id and text exactly one stays. Extra columns stay, whatever their names; an
    empty table gives no rows. Texts that no other row repeats are not shuffled.
    """
    verdicts = exact_dedup(docs)
    # A row goes if no row with its id and text stays; ids and texts may repeat.
    kept = verdicts.groupBy(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies"))
    rows, back, new = plain_names(docs)
    marked = rows.withColumn("id", F.col(new["doc_id"]).cast("bigint")).withColumn(
        "sha", sha256_hex(lower_ascii(F.col(new["text"]))))
    return without_rows(marked, ["id", "sha"], stored(kept, "dedup-verdicts")).select(*back)
