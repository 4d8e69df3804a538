"""Episodes: numbering, frames, tasks, statistics and file assignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from robolog.contracts import NS
from robolog.operators.joins import side_join
from robolog.operators.layout import Layout, measure
from robolog.operators.scan import numbered, row_number, scan

FILES_PER_CHUNK = 1000
MB = 1024 * 1024


def episode_table(
    rows: DataFrame, *, segment: str = "segment_id", ts: str = "ts_ns"
) -> DataFrame:
    """Non-empty segments numbered by id, with length, first time and first global index."""
    counts = rows.groupBy(segment).agg(
        F.count(F.lit(1)).alias("length"), F.min(ts).alias("first_ns")
    )
    return numbered(counts, segment, "episode_index", first_index="length")


def episode_index(segments: DataFrame, *, segment: str = "segment_id", rows: str = "n_rows") -> DataFrame:
    """Episode numbers of a segment table; segments without rows get none."""
    return numbered(segments.where(F.col(rows) > 0), segment, "episode_index")


def number_frames(
    rows: DataFrame,
    episodes: DataFrame,
    *,
    segment: str = "segment_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    layout: Layout | None = None,
    target_rows: int | None = None,
    size: int | None = None,
) -> DataFrame:
    """Add episode_index, frame_index, index and timestamp to the rows of each episode.

    Only the frame number needs an order. The global index is the frame number plus the
    running total kept in the small ``episodes`` table.
    """
    if layout is None:
        layout = measure(rows, [segment], [ts, seq], target_rows)
    ordered = scan(rows, [segment], [ts, seq], layout, _rn=row_number())
    side = episodes.select(segment, "episode_index", "first_index", "first_ns")
    joined = side_join(ordered, side, [segment], "inner", rows=layout.n_keys, size=size)
    seconds = (F.col(ts) - F.col("first_ns")) / float(NS)
    return (
        joined.withColumn("frame_index", F.col("_rn") - 1)
        .withColumn("index", F.col("first_index") + F.col("frame_index"))
        .withColumn("timestamp", seconds.cast("float"))
        .drop("_rn", "first_index", "first_ns")
    )


def file_places(
    episodes: DataFrame, *, target_mb: float, files_per_chunk: int = FILES_PER_CHUNK
) -> DataFrame:
    """Chunk and file of episodes whose ``bytes_before`` is known: a file is full once it has the target size."""
    file = F.floor(F.col("bytes_before") / F.lit(target_mb * MB)).cast("bigint")
    return (
        episodes.withColumn("_file", file)
        .withColumn("chunk_index", F.expr(f"_file DIV {files_per_chunk}"))
        .withColumn("file_index", F.expr(f"_file % {files_per_chunk}"))
        .drop("_file")
    )


def file_number(chunk: str = "chunk_index", file: str = "file_index", *, files_per_chunk: int = FILES_PER_CHUNK) -> Column:
    """Number of a file over all chunks; the file index starts anew in each."""
    return F.col(chunk).cast("bigint") * files_per_chunk + F.col(file)


def task_table(
    rows: DataFrame, *, order: Sequence[str] = ("segment_id", "ts_ns", "seq"), task: str = "task", known: DataFrame | None = None
) -> DataFrame:
    """Tasks numbered by first appearance over all episodes: (task_index, task).

    ``known`` is such a table of earlier episodes: its tasks are left out, the new ones go on after it.
    """
    first = rows.groupBy(task).agg(F.min(F.struct(*order)).alias("_first"))
    if known is None:
        return numbered(first, "_first", "task_index").select("task_index", task)
    after = known.agg(F.coalesce(F.max("task_index") + 1, F.lit(0)).alias("n")).first().n
    new = numbered(first.join(known.select(task), task, "left_anti"), "_first", "task_index")
    return new.select((F.col("task_index") + after).alias("task_index"), task)


def task_join(rows: DataFrame, tasks: DataFrame, task: str = "task") -> DataFrame:
    """Add task_index by an equi-join on the task text."""
    return side_join(rows, tasks, [task], "inner")


def episode_tasks(
    rows: DataFrame,
    *,
    episode: str = "segment_id",
    order: Sequence[str] = ("ts_ns", "seq"),
    task: str = "task",
    target_rows: int | None = None,
) -> DataFrame:
    """Distinct tasks of each episode in first-seen order: (episode, position, task).

    A row per task instead of an array per episode, so free text cannot pile up in one row.
    """
    first = rows.groupBy(episode, task).agg(F.min(F.struct(*order)).alias("_first"))
    flat = first.select(episode, task, *[F.col("_first")[c].alias(f"_o{i}") for i, c in enumerate(order)])
    by = [f"_o{i}" for i in range(len(order))]
    ranked = scan(flat, [episode], by, target_rows=target_rows, _rn=row_number())
    return ranked.select(episode, (F.col("_rn") - 1).alias("position"), task)


def episode_stats(
    rows: DataFrame, features: Mapping[str, str], *, episode: str = "episode_index"
) -> DataFrame:
    """Min, max, mean, population std and count per episode, feature and dimension.

    The explode is narrow and is combined per task before the exchange, which carries one
    partial row per (episode, feature, dimension).
    """
    named = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(c).cast("array<double>").alias("vector"))
            for f, c in features.items()
        ]
    )
    long = rows.select(episode, F.inline(named)).select(
        episode, "feature", F.posexplode("vector").alias("dim", "value")
    )
    return long.groupBy(episode, "feature", F.col("dim").cast("bigint").alias("dim")).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.count("value").alias("count"),
    )


def stats_arrays(stats: DataFrame, *, episode: str = "episode_index") -> DataFrame:
    """The statistics with one array per measure, in dimension order (a bounded width)."""
    measures = ["min", "max", "mean", "std", "count"]
    rows = F.array_sort(F.collect_list(F.struct("dim", *measures)))
    grouped = stats.groupBy(episode, "feature").agg(rows.alias("_rows"))
    return grouped.select(
        episode, "feature", *[F.col("_rows")[m].alias(m) for m in measures]
    )


def file_assignment(
    episodes: DataFrame,
    *,
    order: str = "episode_index",
    size: str = "size_bytes",
    target_mb: float = 100.0,
    files_per_chunk: int = FILES_PER_CHUNK,
    template: str = "data/chunk-%03d/file-%03d.parquet",
) -> DataFrame:
    """Chunk and file of each episode: a file is full once it has reached the target size."""
    sized = numbered(episodes, order, "_row", bytes_before=size).drop("_row")
    placed = file_places(sized, target_mb=target_mb, files_per_chunk=files_per_chunk)
    return placed.withColumn("path", F.format_string(template, "chunk_index", "file_index"))
