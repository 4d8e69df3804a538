"""Choosing recordings, paths, columns and timelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from robolog.contracts import (
    CODEC_COLUMN_HINTS,
    FALLBACK_EXCLUDES,
    IMAGE_COLUMN_HINTS,
    POSE_PATHS,
    TIMELINES,
    ExportSpec,
    training_contents,
)
from robolog.operators.joins import side_join


def in_contents(path: Column, contents: Sequence[str]) -> Column:
    """Whether a path is selected; ``/a/**`` selects ``/a`` and everything below it."""
    exact = [c for c in contents if not c.endswith("/**")]
    trees = [c.removesuffix("/**") for c in contents if c.endswith("/**")]
    chosen = path.isin(*exact, *trees)
    for root in trees:
        chosen = chosen | path.startswith(root + "/")
    return chosen


def filter_contents(df: DataFrame, contents: Sequence[str], topic: str = "entity_path") -> DataFrame:
    return df.where(in_contents(F.col(topic), contents))


def filter_segments(df: DataFrame, segments: Sequence, segment: str = "bag_id") -> DataFrame:
    """Rows of the given segments: a literal list, so it reaches the scan."""
    return df.where(F.col(segment).isin(*segments))


def entity_path(column: str) -> str:
    """Path part of a fully qualified ``path:component:field`` name."""
    return column.split(":")[0]


def spec_paths(spec: ExportSpec) -> list[str]:
    """Paths an export needs, in first-use order; the first is the clock."""
    qualified = spec.action + spec.state + ([spec.task] if spec.task else [])
    wanted = [entity_path(c) for c in qualified] + list(spec.cameras.values())
    return list(dict.fromkeys(wanted))


def clock_path(spec: ExportSpec) -> str | None:
    vectors = spec.action + spec.state
    return entity_path(vectors[0]) if vectors else None


def paths_in_use(df: DataFrame, spec: ExportSpec, topic: str = "entity_path") -> DataFrame:
    """Rows per path an export needs, with its position and the clock flag."""
    paths = spec_paths(spec)
    position = F.create_map(*[F.lit(x) for i, p in enumerate(paths) for x in (p, i)])
    return (
        df.where(F.col(topic).isin(*paths))
        .groupBy(topic)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            topic,
            F.try_element_at(position, F.col(topic)).cast("bigint").alias("position"),
            (F.col(topic) == F.lit(clock_path(spec))).alias("is_clock"),
            "n_rows",
        )
    )


def wide_reader(
    df: DataFrame,
    columns: Mapping[str, str],
    *,
    keys: Sequence[str] = ("bag_id", "ts_ns"),
    name: str = "entity_path",
    value: str = "value",
    seq: str = "seq",
) -> DataFrame:
    """One row per index value, one column per component.

    The column list is given, so no job is needed to find it; the last value wins when an
    index value holds several.
    """
    return (
        df.where(F.col(name).isin(*columns))
        .groupBy(*keys)
        .agg(
            *[
                F.max_by(value, F.when((F.col(name) == path) & F.col(value).isNotNull(), F.col(seq))).alias(out)
                for path, out in columns.items()
            ]
        )
    )


def training_view(
    df: DataFrame,
    mode: str,
    columns: Mapping[str, str],
    *,
    with_text: bool = True,
    **names,
) -> DataFrame:
    """The wide rows training needs for an end-effector mode."""
    topic = names.get("name", "entity_path")
    return wide_reader(filter_contents(df, training_contents(mode, with_text), topic), columns, **names)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def nonnull_samples(df: DataFrame, index: Sequence[str], sample: str = "sample") -> DataFrame:
    return df.where(F.col(sample).isNotNull()).select(*index, sample)


def first_sample(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    order: Sequence[str] = ("ts_ns", "seq"),
    sample: str = "sample",
) -> DataFrame:
    """``columns`` of the first row per key whose sample is not null."""
    at = F.when(F.col(sample).isNotNull(), F.struct(*order))
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*columns), at).alias("_first"))
        .select(*keys, *[F.col("_first")[c].alias(c) for c in columns])
    )


def pick_columns(
    presence: DataFrame,
    preferences: Mapping[str, Sequence[str]],
    *,
    bag: str = "bag_id",
    path: str = "entity_path",
    column: str = "column_name",
) -> DataFrame:
    """Data columns per recording and path: (bag, path, position, column).

    ``presence`` has a row per column a recording holds (repeats are harmless). The best
    ranked column wins; a pose path takes its two best when it has two. Without any ranked
    column the first other column of the path is used, message envelopes excluded. Paths
    without a usable column give no row: see ``missing_columns``.
    """
    ranks = {c: i for path_columns in preferences.values() for i, c in enumerate(path_columns)}
    rank = F.try_element_at(F.create_map(*[F.lit(x) for p in ranks.items() for x in p]), F.col(column))
    belongs = F.col(column).startswith(F.concat(F.col(path), F.lit(":")))
    other = belongs & rank.isNull() & ~F.col(column).contains(FALLBACK_EXCLUDES)
    # At most as many distinct entries as the path has preferences.
    ranked = F.collect_set(
        F.when(rank.isNotNull() & belongs, F.struct(rank.alias("rank"), F.col(column).alias("name")))
    )
    picked = (
        presence.where(F.col(path).isin(*preferences))
        .groupBy(bag, path)
        .agg(F.array_sort(ranked).alias("_ranked"), F.min(F.when(other, F.col(column))).alias("_other"))
    )
    take = F.when(F.col(path).isin(*POSE_PATHS), F.lit(2)).otherwise(F.lit(1))
    named = F.transform(F.slice("_ranked", F.lit(1), take), lambda r: r["name"])
    fallback = F.array_compact(F.array("_other"))
    chosen = F.when(F.size("_ranked") > 0, named).otherwise(fallback)
    return picked.select(bag, path, F.posexplode(chosen).alias("position", column)).withColumn(
        "position", F.col("position").cast("bigint")
    )


def pick_state_columns(presence: DataFrame, mode_paths: Sequence[str], **names) -> DataFrame:
    """Column choice at export: the pose pair only when complete, else the scalar column."""
    bag, path = names.get("bag", "bag_id"), names.get("path", "entity_path")
    column = names.get("column", "column_name")
    suffix = F.substring_index(F.col(column), ":", -2)

    def has(component: str) -> Column:
        return F.max(suffix == component)

    found = (
        presence.where(F.col(path).isin(*mode_paths))
        .groupBy(bag, path)
        .agg(
            (has("InstancePoses3D:translations") & has("InstancePoses3D:quaternions")).alias("_pose"),
            has("Scalars:scalars").alias("_scalar"),
        )
    )
    pose = F.array(F.lit("InstancePoses3D:translations"), F.lit("InstancePoses3D:quaternions"))
    chosen = (
        F.when(F.col("_pose") & F.col(path).isin(*POSE_PATHS), pose)
        .when(F.col("_scalar"), F.array(F.lit("Scalars:scalars")))
        .otherwise(F.array().cast("array<string>"))
    )
    return found.select(bag, path, F.posexplode(chosen).alias("position", "_c")).select(
        bag, path, F.col("position").cast("bigint"), F.concat_ws(":", path, "_c").alias(column)
    )


def available_timelines(
    df: DataFrame, timelines: Mapping[str, str], *, bag: str = "bag_id"
) -> DataFrame:
    """Timelines that hold values, per recording. ``timelines`` maps a name to its column."""
    present = df.groupBy(bag).agg(
        *[F.max(F.col(c).isNotNull()).alias(f"_{i}") for i, c in enumerate(timelines.values())]
    )
    listed = F.array(
        *[F.when(F.col(f"_{i}"), F.lit(name)) for i, name in enumerate(timelines)]
    )
    return present.select(bag, F.explode(F.array_compact(listed)).alias("timeline"))


def pick_timeline(available: DataFrame, *, bag: str = "bag_id") -> DataFrame:
    """The preferred timeline of each recording, else its first by name."""
    rank = F.lit(len(TIMELINES))
    for i, name in enumerate(TIMELINES):
        rank = F.when(F.col("timeline") == name, F.lit(i)).otherwise(rank)
    return available.groupBy(bag).agg(F.min_by("timeline", F.struct(rank, "timeline")).alias("timeline"))


def segment_table(
    df: DataFrame, *, segment: str = "bag_id", payload: str = "payload", ts: str = "ts_ns"
) -> DataFrame:
    """Rows, payload bytes and time span per segment."""
    return df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.octet_length(payload)), F.lit(0)).cast("bigint").alias("size_bytes"),
        F.min(ts).alias("first_ns"),
        F.max(ts).alias("last_ns"),
    )


def segment_files_table(df: DataFrame, *, segment: str = "segment_id", ts: str = "ts_ns") -> DataFrame:
    """The segment table of logs with one segment a file: the bytes are those of the file, no payload is read.

    ``df`` comes straight from ``spark.read``. A file without rows is no segment; two files of one name are one segment.
    """
    per_file = df.groupBy(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias(segment)).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"), F.min(ts).alias("first"), F.max(ts).alias("last")
    )
    return per_file.groupBy(segment).agg(
        F.sum("n").alias("n_rows"), F.sum("size").alias("size_bytes"), F.min("first").alias("first_ns"), F.max("last").alias("last_ns")
    )


def nonempty_segments(
    df: DataFrame, segments: DataFrame, segment: str = "bag_id", size: str = "size_bytes"
) -> DataFrame:
    """Rows of segments that are not empty. ``segments`` is the segment table."""
    empty = segments.where(F.col(size) == 0).select(segment)
    return side_join(df, empty, [segment], "left_anti")


def first_segments(df: DataFrame, n: int, segment: str = "bag_id") -> DataFrame:
    """Rows of the first ``n`` segments by id (the limit is what is asked for)."""
    chosen = df.select(segment).distinct().orderBy(segment).limit(n)
    return side_join(df, chosen, [segment], "left_semi", rows=n)


def last_segment(df: DataFrame, recording: str, segment: str) -> DataFrame:
    """Rows of the last segment of each recording."""
    last = df.groupBy(recording).agg(F.max(segment).alias(segment))
    return side_join(df, last, [recording, segment], "left_semi")


def pick_image_columns(
    presence: DataFrame, path: str, *, bag: str = "bag_id", column: str = "column_name"
) -> DataFrame:
    """Per recording the column that holds the images of ``path`` and the one that names their codec.

    ``presence`` has a row per column a recording holds (repeats are harmless). The image column
    is the first by name that has one of the hints, else the first of the path; the codec
    column is the first by the rank of its hint. Either is null if there is none.
    """
    name = F.col(column)
    hinted = F.lit(False)
    for hint in IMAGE_COLUMN_HINTS:
        hinted = hinted | name.contains(hint)
    rank = F.lit(None).cast("int")
    for i, hint in reversed(list(enumerate(CODEC_COLUMN_HINTS))):
        rank = F.when(name.contains(hint), F.lit(i)).otherwise(rank)
    return (
        presence.where(name.startswith(path + ":"))
        .groupBy(bag)
        .agg(
            F.coalesce(F.min(F.when(hinted, name)), F.min(name)).alias("image_column"),
            F.min_by(name, F.when(rank.isNotNull(), F.struct(rank, name))).alias("codec_column"),
        )
    )


def reindex_timeline(
    df: DataFrame,
    timelines: Mapping[str, str],
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    picked: DataFrame | None = None,
) -> DataFrame:
    """Rows keyed by the preferred timeline of their recording: column ``ts`` and ``timeline``.

    Rows without a value on that timeline are left out, as they have no place on it; recordings
    without any timeline are listed by ``untimed_recordings``.
    """
    picked = pick_timeline(available_timelines(df, timelines, bag=bag), bag=bag) if picked is None else picked
    joined = side_join(df, picked.select(bag, "timeline"), [bag], "inner")
    at = F.lit(None).cast("bigint")
    for name, column in timelines.items():
        at = F.when(F.col("timeline") == name, F.col(column)).otherwise(at)
    return joined.withColumn(ts, at).where(F.col(ts).isNotNull())


def untimed_recordings(df: DataFrame, timelines: Mapping[str, str], *, bag: str = "bag_id") -> DataFrame:
    """Recordings whose rows hold no value on any timeline."""
    some = F.lit(False)
    for column in timelines.values():
        some = some | F.col(column).isNotNull()
    return df.groupBy(bag).agg(F.max(some).alias("_some")).where("NOT _some").select(bag)
