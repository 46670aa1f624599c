"""Session settings shared by the bench, the tests and local runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the submitted configuration is used instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daypanel")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``; ``fallback`` is used only where that
    setting and the context's own are both unset.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    target = configured or fallback
    if not target:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(target)
    return target


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder; only a local session may fall back to a temporary folder."""
    local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
    unset = not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()
    fallback = tempfile.mkdtemp(prefix="checkpoints-") if unset and local else None
    return f"{ensure_checkpoint_dir(spark, fallback).rstrip('/')}/{uuid.uuid4().hex}"


def scratch_table(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the shared checkpoint folder and read from there.

    Cuts lineage so that a lost executor costs no recomputation of what came before, and fixes what a plan may not
    compute twice. The folder is scratch: its owner clears it after a job. A local session may
    fall back to a temporary folder; a cluster must name one that every executor can reach.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
