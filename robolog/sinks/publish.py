"""Writing message logs, aligned rows and datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from robolog.sinks.versions import load_version, read_version

ROWS_PER_FILE = 5_000_000


def write_by_bag(
    df: DataFrame,
    path: str,
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    mode: str = "overwrite",
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """One folder per recording, replacing only the recordings that are written.

    Rows are range partitioned by (recording, time): a task holds few recordings, so there
    are few files, and a long recording is spread over several tasks.
    """
    (
        df.repartitionByRange(bag, ts)
        .sortWithinPartitions(bag, ts)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(bag)
        .parquet(path)
    )


def write_dataset(
    frames: DataFrame,
    meta: Mapping[str, DataFrame],
    path: str,
    *,
    replace: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    batch: str | None = None,
) -> None:
    """A dataset folder: ``data/`` by chunk and file, and one table per entry of ``meta``.

    With ``batch`` all of it goes into that batch, see ``versions``. ``replace=False`` refuses an existing output. Frames need ``chunk_index``, ``file_index``,
    ``episode_index`` and ``frame_index``. The rows of one (chunk, file) go to one task, in
    blocks of ``rows_per_file`` frames of an episode, so that a very long episode is spread
    over several tasks and part files of its folder.
    """
    mode = "overwrite" if replace else "errorifexists"
    block = F.floor(F.col("frame_index") / F.lit(rows_per_file))
    (
        frames.repartition("chunk_index", "file_index", block)
        .sortWithinPartitions("chunk_index", "file_index", "episode_index", "frame_index")
        .write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("chunk_index", "file_index")
        .parquet(f"{path}/data{_below(batch)}")
    )
    write_meta(meta, path, replace=replace, batch=batch)


def _below(batch: str | None) -> str:
    return f"/batch={batch}" if batch else ""


def episode_files(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """The files the episodes are in: (episode_index, path below the dataset, n_rows), read off the data."""
    data = spark.read.parquet(f"{path}/data{_below(batch)}")
    name = F.concat(F.lit("data/"), F.substring_index(F.col("_metadata.file_path"), "/", -4 if batch else -3))
    return data.select("episode_index", name.alias("path")).groupBy("episode_index", "path").agg(F.count(F.lit(1)).alias("n_rows"))


def write_meta(tables: Mapping[str, DataFrame], path: str, *, replace: bool = False, batch: str | None = None) -> None:
    """Metadata tables of a dataset."""
    mode = "overwrite" if replace else "errorifexists"
    for name, table in tables.items():
        table.write.mode(mode).parquet(f"{path}/meta/{name}{_below(batch)}")


def read_dataset(spark: SparkSession, path: str, table: str = "data", version: int | None = None) -> DataFrame:
    """A table of the latest version or of one by number; of a folder without versions, what lies there."""
    if version is not None or load_version(spark, path):
        return read_version(spark, path, table, version)
    return spark.read.parquet(f"{path}/{table}" if table == "data" else f"{path}/meta/{table}")
