"""Session set-up and the shared work folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may go without that setting; it gets a temporary
    folder. On a cluster a missing setting is an error, because the executors
    and a restarted driver could not see a folder of one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="shelfmark-")
    return _local_folders[app]


def materialize(source: DataFrame | Callable[[], DataFrame], label: str, folder: str | None = None,
                resume: bool = False) -> DataFrame:
    """Write ``source`` once as Parquet and return a scan of what was written.

    Cuts the lineage: later branches read the same rows instead of computing
    them again, also after executors were lost. With ``resume`` a table that an
    earlier run finished in ``folder`` is read; a function as ``source`` is
    then not even called.
    """
    spark = source.sparkSession if isinstance(source, DataFrame) else SparkSession.active()
    path = f"{folder or run_folder(spark)}/{label}"
    if resume and finished(spark, path):
        return spark.read.parquet(path)
    df = source if isinstance(source, DataFrame) else source()
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_in_waves(inputs: DataFrame, key: str, make: Callable[[DataFrame], DataFrame], label: str,
                         folder: str, waves: int, resume: bool = False) -> DataFrame:
    """``make(inputs)`` in ``waves`` writes that are committed one by one.

    For results that are costly to make again: a run that breaks off loses the
    wave it was in, and with ``resume`` the next run goes on from there. The
    inputs are written once, partitioned by wave, so no wave scans them all.
    Use :func:`open_run` first: it refuses a resume with other settings.
    """
    spark = inputs.sparkSession
    if waves > 1:
        path = f"{folder}/{label}/inputs"
        if not (resume and finished(spark, path)):
            inputs.withColumn("__wave", F.pmod(F.xxhash64(key), F.lit(waves)).cast("int")).write.mode(
                "overwrite").partitionBy("__wave").parquet(path)
        schema = T.StructType([*inputs.schema, T.StructField("__wave", T.IntegerType())])
        inputs = spark.read.schema(schema).parquet(path)
    tables = []
    for wave in range(waves):
        part = inputs.where(F.col("__wave") == wave).drop("__wave") if waves > 1 else inputs
        tables.append(materialize(lambda part=part: make(part), f"{label}/wave-{wave}", folder, resume))
    paths = [f"{folder}/{label}/wave-{wave}" for wave in range(waves)]
    return spark.read.schema(tables[0].schema).parquet(*paths)


def open_run(spark: SparkSession, folder: str, resume: bool, settings: dict[str, object]) -> None:
    """Note the settings of a run in ``folder``; a resume with other settings is an error.

    Without that, tables of another input, wave count or parameter would be
    taken for finished parts of this run.
    """
    path = f"{folder}/run"
    new = json.loads(json.dumps(settings, default=str))
    if resume and finished(spark, path):
        old = json.loads(spark.read.parquet(path).first()["settings"])
        different = sorted(name for name in old.keys() | new.keys() if old.get(name) != new.get(name))
        if different:
            raise ValueError(f"{folder} holds a run with other settings: {', '.join(different)}")
        return
    spark.createDataFrame([(json.dumps(new),)], "settings string").coalesce(1).write.mode("overwrite").parquet(path)


def fingerprint(df: DataFrame) -> str:
    """Row count and combined hash of a table's rows, whatever their order: one pass with partial sums."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{row.n}:{row.h or 0}"


def run_folder(spark: SparkSession) -> str:
    """A new folder for the intermediate tables of one run."""
    return f"{work_dir(spark)}/shelfmark/{uuid.uuid4().hex}"


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Small session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfmark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
