"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "robolog", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Settings are given with ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent in a session with a single process (a local test) is a
    temporary folder used.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = "file://" + tempfile.mkdtemp(prefix="robolog-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a small intermediate once to the shared folder and cut its lineage."""
    scratch_root(df.sparkSession)
    return df.checkpoint()


def write_once(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a large intermediate as Parquet below the shared folder and read it back.

    For rows several later steps read: what is behind them runs once, and a lost executor
    costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, "stage")
        _staged.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str | None = None, **metrics: Column) -> tuple[DataFrame, dict]:
    """``write_once``, and aggregates of the rows that are taken as they are written, without a pass of their own."""
    counts = Observation()
    written = write_once(df.observe(counts, *[c.alias(name) for name, c in metrics.items()]), path)
    return written, counts.get


_staged: list[str] = []


@contextmanager
def discard_staged(spark: SparkSession):
    """Remove, on leaving, the folders that ``write_once`` has filled inside the block.

    For jobs that end by writing their result elsewhere: nothing read after the block may
    depend on them. (Checkpoints are removed by Spark when their tables are no longer in use.)
    """
    before = len(_staged)
    try:
        yield
    finally:
        for path in _staged[before:]:
            remove(spark, path)
        del _staged[before:]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
