"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "dugout", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    Adaptive execution sizes shuffle partitions, splits skewed join partitions and
    switches to broadcast joins from measured sizes, so none of these are fixed here.
    Keyword arguments use ``__`` for dots: ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` decides. Only a local session without that setting
    falls back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="dugout-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def scratch_home(spark: SparkSession) -> str:
    """This application's own folder below the scratch folder."""
    return f"{scratch_root(spark)}/dugout-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the application's scratch folder that nobody else uses."""
    return f"{scratch_home(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application, at its end: tables that were read
    from them can't be used any more. Other applications' folders stay."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(scratch_home(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    It cuts the lineage, survives lost executors, is computed once however often it is
    used, and gives the optimizer the real size, so that a later join broadcasts the
    table only if it fits under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
