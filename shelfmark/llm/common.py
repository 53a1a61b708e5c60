"""Small helpers that several training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.session import work_dir

_SLICES = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all nodes share."""
    return f"{work_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the files."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor)).cast("int")


def sample_of_class(rows: DataFrame, key: str, label: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each value of ``label``, chosen by the hash of ``key``.

    Ranked within slices of the hash first, so a class of any size is cut down
    by many tasks; the last window sees ``_SLICES * per_class`` rows of a class.
    Both windows have a partial limit before their shuffle.
    """
    digest = F.xxhash64(F.col(key))
    sliced = rows.withColumn("_class", label).withColumn("_slice", F.pmod(digest, F.lit(_SLICES)))
    for parts in (["_class", "_slice"], ["_class"]):
        order = Window.partitionBy(*parts).orderBy(digest, F.col(key))
        sliced = sliced.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_class).drop("_rank")
    return sliced.drop("_class", "_slice")


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def plain_names(rows: DataFrame) -> tuple[DataFrame, list[Column], dict[str, str]]:
    """``rows`` with columns c0, c1, ..., the columns under their old names again, and the new name of each.

    Between the two an operator may add columns of its own that clash with none.
    """
    new = {name: f"c{i}" for i, name in enumerate(rows.columns)}
    renamed = rows.select(*[F.col(quoted(old)).alias(c) for old, c in new.items()])
    return renamed, [F.col(c).alias(old) for old, c in new.items()], new


#: Bits of one bitmap of Spark's bitmap functions.
_BITMAP_BITS = 32_768


def mark_possible(rows: DataFrame, digest: Column, keys: DataFrame, name: str, bits_per_key: int = 16,
                  max_bytes: int = 32 * 1024**2) -> DataFrame:
    """``rows`` with boolean ``name``: false only where ``digest`` is none of the hashes in ``keys(hash)``.

    One bit for each hash in bitmaps of ``bits_per_key`` times as many bits, so
    about one other row in ``bits_per_key`` is possible too. The bitmaps are
    broadcast and never exceed ``max_bytes``; with more keys than that serves,
    more rows are possible. An exact join has to follow, which then need not
    move the rows that are not possible.
    """
    count = keys.count()
    buckets = max(1, min(-(-count * bits_per_key // _BITMAP_BITS), max_bytes // (_BITMAP_BITS // 8)))

    def place(value: Column) -> Column:
        return F.pmod(value, F.lit(buckets * _BITMAP_BITS))

    at = place(F.col("hash"))
    bitmaps = keys.where("hash IS NOT NULL").groupBy(F.floor(at / _BITMAP_BITS).cast("int").alias("__bucket")).agg(
        F.bitmap_construct_agg(at % _BITMAP_BITS).alias("__bits"))
    marked = rows.withColumn("__at", place(digest)).withColumn("__bucket", F.floor(F.col("__at") / _BITMAP_BITS).cast("int"))
    bit = F.col("__at") % _BITMAP_BITS
    byte = F.conv(F.hex(F.substr(F.col("__bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.floor(byte / F.pow(F.lit(2.0), bit % 8)).cast("int") % 2 == 1, F.lit(False))
    joined = marked.join(F.broadcast(bitmaps), "__bucket", "left")
    return joined.withColumn(name, found).drop("__at", "__bucket", "__bits")


def without_rows(rows: DataFrame, keys: list[str], verdicts: DataFrame) -> DataFrame:
    """``rows`` without those that ``verdicts`` (``keys``, ``kept``, ``copies``) drops, and of kept copies one row.

    ``verdicts`` has one row for each combination of ``keys``. Only rows whose
    keys are dropped or repeated, and about one in sixteen others, are
    shuffled; the rest passes where it lies. Null keys are keys like others.
    """
    special = verdicts.where(~F.col("kept") | (F.col("copies") > 1)).select(*keys, "kept")
    digest = F.xxhash64(*keys)
    marked = mark_possible(rows, digest, special.select(digest.alias("hash")), "__possible")
    others = marked.where(~F.col("__possible")).drop("__possible")
    right = special.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("kept").alias("__kept"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    met = marked.where("__possible").drop("__possible").join(right, same, "left")
    free = met.where(F.col("__kept").isNull()).select(rows.columns)
    # An aggregate, so that copies are reduced within tasks.
    held = [c for c in rows.columns if c not in keys]
    once = met.where("__kept").groupBy(*keys).agg(F.first(F.struct(*held)).alias("__row")).select(*keys, "__row.*")
    return others.select(rows.columns).unionByName(free).unionByName(once.select(rows.columns))
