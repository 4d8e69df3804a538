"""Versions of a dataset folder: files come in batches, and a manifest written last names the batches of a version.

Layout: ``data/batch=<b>/...``, ``meta/<table>/batch=<b>/...`` and ``versions/v000001/`` with one row per batch.
Readers see a batch only through a manifest, so a job that dies leaves the version before it as it was, and files
of a version never change. A manifest is moved into place under the next number; where another writer has taken
the number, the move fails and so does the publication.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from robolog.session import remove

#: Tables that each batch holds for the whole version: readers take the newest batch's.
WHOLE_TABLES = ("info", "features", "dataset_stats")
MODES = ("new", "append", "replace")


@dataclass(frozen=True)
class Version:
    number: int
    batches: tuple[str, ...]


def _names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(path)) if files.exists(path) else []


def _move_new(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that must not be taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(source), hadoop.Path(target)
    files = hadoop.FileContext.getFileContext(source.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(source).toUri(), spark._jsc.hadoopConfiguration())
    files.rename(source, target, spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return [int(n[1:]) for n in _names(spark, f"{path}/versions") if re.fullmatch(r"v\d+", n)]


def load_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version's batches in the order they were added; the latest if no number is given, None if there is none."""
    known = version_numbers(spark, path)
    if number is None and not known:
        return None
    number = known[-1] if number is None else number
    if number not in known:
        raise ValueError(f"{path} has no version {number}")
    rows = spark.read.parquet(f"{path}/versions/v{number:06d}").orderBy("position").collect()
    return Version(number, tuple(r.batch for r in rows))


def commit(spark: SparkSession, path: str, batches: tuple[str, ...], after: int) -> Version:
    """Make the next version of these batches; fails if another writer has made it since ``after``."""
    number = after + 1
    waiting = f"{path}/versions/.{uuid.uuid4().hex}"
    spark.createDataFrame([(b, i) for i, b in enumerate(batches)], "batch string, position int").coalesce(1).write.parquet(waiting)
    try:
        _move_new(spark, waiting, f"{path}/versions/v{number:06d}")
    except Exception as taken:
        remove(spark, waiting)
        raise RuntimeError(f"version {number} of {path} already exists: another writer has published it") from taken
    return Version(number, batches)


def _tables(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/data", *(f"{path}/meta/{name}" for name in _names(spark, f"{path}/meta"))]


def drop_batch(spark: SparkSession, path: str, batch: str) -> None:
    """Remove the files of a batch that no version needs."""
    for folder in _tables(spark, path):
        remove(spark, f"{folder}/batch={batch}")


@contextmanager
def publishing(spark: SparkSession, path: str, mode: str = "new") -> Iterator[str]:
    """Gives the name of a new batch to write; at the end of the block a version with it is committed.

    ``new`` refuses a dataset that exists, ``append`` adds the batch to the latest version, ``replace`` makes
    a version of this batch alone. If the block fails its files are removed and no version is made.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}, not {mode}")
    latest = load_version(spark, path)
    if mode == "new" and (latest or _names(spark, f"{path}/data")):
        raise FileExistsError(f"{path} already exists")
    batch = f"b-{uuid.uuid4().hex}"
    try:
        yield batch
        commit(spark, path, (*(latest.batches if latest and mode == "append" else ()), batch), latest.number if latest else 0)
    except BaseException:
        drop_batch(spark, path, batch)
        raise


def read_version(spark: SparkSession, path: str, table: str = "data", number: int | None = None) -> DataFrame:
    """A table of a version; only the files of its batches are listed and read."""
    version = load_version(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"{path} has no version")
    folder = f"{path}/data" if table == "data" else f"{path}/meta/{table}"
    wanted = version.batches[-1:] if table in WHOLE_TABLES else version.batches
    there = set(_names(spark, folder))
    paths = [f"{folder}/batch={b}" for b in wanted if f"batch={b}" in there]
    return spark.read.option("basePath", folder).parquet(*paths).drop("batch")


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Forget all but the last ``keep`` versions, and remove every batch that none of these has. Gives the forgotten numbers.

    Not to be run beside a writer: its batch is no version's yet.
    """
    known = version_numbers(spark, path)
    old = known[: max(0, len(known) - max(1, keep))]
    needed = {b for n in known[len(old):] for b in load_version(spark, path, n).batches}
    for number in old:
        remove(spark, f"{path}/versions/v{number:06d}")
    batches = {n.removeprefix("batch=") for folder in _tables(spark, path) for n in _names(spark, folder) if n.startswith("batch=")}
    for batch in sorted(batches - needed):
        drop_batch(spark, path, batch)
    return old


def compact(spark: SparkSession, path: str) -> Version:
    """A version with the rows of the latest in one batch, so that a file that several batches have added to is one folder again."""
    from robolog.sinks.publish import episode_files, write_dataset, write_meta

    names = [n for n in _names(spark, f"{path}/meta") if n != "episode_files"]
    with publishing(spark, path, "replace") as batch:
        write_dataset(read_version(spark, path), {n: read_version(spark, path, n) for n in names}, path, batch=batch)
        write_meta({"episode_files": episode_files(spark, path, batch)}, path, batch=batch)
    return load_version(spark, path)


def version_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Rows and episodes of every version that can be read: (version, n_batches, n_frames, n_episodes)."""
    out = None
    for number in version_numbers(spark, path):
        row = read_version(spark, path, number=number).agg(
            F.lit(number).alias("version"), F.lit(len(load_version(spark, path, number).batches)).alias("n_batches"),
            F.count(F.lit(1)).alias("n_frames"), F.count_distinct("episode_index").alias("n_episodes"))
        out = row if out is None else out.unionByName(row)
    return out
