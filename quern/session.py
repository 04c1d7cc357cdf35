"""Session settings and the shared scratch area for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "quern", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC; ``master`` only for local runs.

    On a cluster the partition counts come from the cluster's own settings and
    adaptive execution; nothing here pins them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's checkpoint folder.

    A cluster must name it in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quern-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the scratch root."""
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}/{label}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables.

    Call it when no result that still reads them is needed; results are lazy.
    """
    files, target = hadoop_path(spark, _application_folder(spark))
    files.delete(target, True)


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/quern/{spark.sparkContext.applicationId}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the storage that holds ``path``."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = hadoop_path(spark, path)
    return files.exists(target)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch area and read it back.

    The written table cuts the lineage and survives the loss of executors; it
    also gives the planner true sizes for what follows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``stage`` that also returns the number of rows, taken while writing."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return staged, seen.get["rows"]


# Inputs below this many bytes per core are spread over the cores.
SMALL_BYTES_PER_CORE = 16 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores before heavy per-row work on a small input of few splits.

    A large input has more splits than cores and is left where it is. The size
    is the planner's estimate; nothing is run to find it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > cores * SMALL_BYTES_PER_CORE:
        return df
    return df.repartition(cores, key)
