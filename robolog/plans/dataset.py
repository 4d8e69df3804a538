"""From aligned rows to a published dataset of episodes."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from robolog.contracts import DEFAULT_TASK, POSE_COMPONENTS, POSE_PATHS, STATE_WIDTHS, TEXT_PATH, TRANSLATION, column_preferences, source_paths
from robolog.functions.numeric import concat_vectors, has_width, pad_vector
from robolog.functions.times import frame_time, task_text
from robolog.operators.episodes import (
    FILES_PER_CHUNK,
    MB,
    episode_stats,
    episode_table,
    episode_tasks,
    file_number,
    file_places,
    number_frames,
    stats_arrays,
    task_join,
    task_table,
)
from robolog.operators.joins import side_join, table_size
from robolog.operators.layout import measure, totals
from robolog.operators.packing import pack_files
from robolog.operators.quality import report_metrics, require
from robolog.operators.scan import numbered
from robolog.operators.select import pick_columns, reindex_timeline
from robolog.operators.timeline import fps_check, infer_fps
from robolog.operators.vectors import agreed_features, dim_mismatch, infer_features
from robolog.plans.align import AlignedBags, align_bags
from robolog.session import discard_staged, materialize, write_counted, write_once
from robolog.sinks.publish import episode_files, read_dataset, write_dataset, write_meta
from robolog.sinks.versions import load_version, publishing
from robolog.sources.catalog import in_bags, list_files, missing_files, read_anchors
from robolog.sources.log import ingest_report, parsed, read_frames, read_messages, timeline_columns


VECTORS = {"action": "action", "observation_state": "observation_state"}


@dataclass(frozen=True)
class Dataset:
    """Numbered frames and their tables; ``rejected`` has (segment, n_bad, reason) of what is not in them."""

    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    rejected: DataFrame
    info: DataFrame
    features: DataFrame | None = None


@dataclass(frozen=True)
class DatasetState:
    """What a published version holds so far, read off its small tables: where the next batch goes on."""

    path: str
    n_episodes: int
    n_frames: int
    episodes: DataFrame
    tasks: DataFrame
    info: DataFrame


def dataset_state(spark: SparkSession, path: str) -> DatasetState:
    """The latest version's totals and tables; the frames themselves are not read."""
    if load_version(spark, path) is None:
        raise FileNotFoundError(f"{path} has no published version to go on from")
    episodes = read_dataset(spark, path, "episodes")
    last = episodes.agg(
        F.coalesce(F.max("episode_index") + 1, F.lit(0)).alias("episodes"), F.coalesce(F.max(F.col("first_index") + F.col("length")), F.lit(0)).alias("frames")
    ).first()
    return DatasetState(path, last.episodes, last.frames, episodes, read_dataset(spark, path, "tasks"), read_dataset(spark, path, "info"))


def _refuse_repeats(segments: DataFrame, segment: str, state: DatasetState) -> None:
    again = segments.select(F.col(segment).alias("segment_id")).join(state.episodes.select("segment_id"), "segment_id", "left_semi")
    names = [str(r.segment_id) for r in again.limit(3).collect()]
    if names:
        raise ValueError(f"already in {state.path}: {', '.join(names)}")


def episode_frames(
    rows: DataFrame,
    action: Sequence[str],
    state: Sequence[str],
    *,
    segment: str = "segment_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    task: str | None = None,
    task_default: str = DEFAULT_TASK,
    task_override: str | None = None,
    stage: bool = False,
    target_rows: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Episode rows with counters, vectors and tasks: (frames, episodes, tasks).

    Rows with a missing action or state part are left out before anything is numbered, so
    an episode without usable rows gets no number. The rows are read for the counts, the
    tasks and the frames; ``stage`` writes them once first, for inputs dearer than a scan.
    """
    complete = rows.dropna(subset=[*action, *state])
    source = F.col(task) if task else F.lit(None).cast("string")
    dtype = rows.schema[task].dataType if task else T.StringType()
    named = complete.select(
        segment,
        ts,
        seq,
        task_text(source, dtype, task_default, task_override).alias("task"),
        concat_vectors(*[F.col(c) for c in action]).alias("action"),
        concat_vectors(*[F.col(c) for c in state]).alias("observation_state"),
    )
    if stage:
        named = write_once(named)
    episodes = episode_table(named, segment=segment, ts=ts)
    layout = measure(named, [segment], [ts, seq], target_rows, totals(episodes, "length"))
    numbered = number_frames(named, episodes, segment=segment, ts=ts, seq=seq, layout=layout)
    tasks = task_table(named, order=(segment, ts, seq))
    return task_join(numbered, tasks), episodes, tasks


def build_dataset(
    rows: DataFrame,
    action: Sequence[str],
    state: Sequence[str],
    *,
    action_dim: int,
    state_dim: int,
    segment: str = "segment_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    file_mb: float = 100.0,
    task: str | None = None,
    task_default: str = DEFAULT_TASK,
    task_override: str | None = None,
    fps: DataFrame | None = None,
    target_rows: int | None = None,
    state_before: DatasetState | None = None,
    packing: str = "even",
    names: Mapping[str, Sequence[str]] | None = None,
    images: DataFrame | None = None,
) -> Dataset:
    """All segments to one dataset, with file assignment and totals.

    Segments that hold a vector of another width are rejected as a whole and listed. The rows
    are written once, with vectors and task text; rejects, lengths, tasks and frames all come
    from that table. ``fps`` (segment, fps) gives the rates that ``info`` reports.

    With ``state_before`` (:func:`dataset_state`) the numbers of episodes, frames and tasks and the
    file places go on where that version ends, ``tasks`` are the new ones only, and ``info`` has the
    totals of both. A segment that the version has is an error, and so are other vector widths.

    ``packing`` is ``even`` (a file per ``file_mb`` of all bytes before an episode) or ``next_fit`` (an
    episode that would fill the current file opens the next, see ``pack_files``). The published features
    are those found in the rows: vector widths with ``names`` (of ``action`` and ``observation_state``),
    the counters, and ``images``, a table of image features per segment (:func:`image_features`) as far
    as the segments agree on them.
    """
    if packing not in ("even", "next_fit"):
        raise ValueError(f"unknown packing {packing}")
    complete = rows.dropna(subset=[*action, *state])
    source = F.col(task) if task else F.lit(None).cast("string")
    dtype = rows.schema[task].dataType if task else T.StringType()
    staged = write_once(complete.select(
        segment,
        ts,
        seq,
        task_text(source, dtype, task_default, task_override).alias("task"),
        concat_vectors(*[F.col(c) for c in action]).alias("action"),
        concat_vectors(*[F.col(c) for c in state]).alias("observation_state"),
    ))
    fits = has_width(F.col("action"), action_dim) & has_width(F.col("observation_state"), state_dim)
    # One row per segment, measured once; all that follows about segments is read off it.
    segments = materialize(
        staged.groupBy(segment).agg(
            F.count(F.lit(1)).alias("length"), F.min(ts).alias("first_ns"), F.count_if(~fits).alias("n_bad")
        )
    )
    n_segments, size = table_size(segments)
    if state_before:
        _refuse_repeats(segments, segment, state_before)
        before = state_before.info.first()
        if (before.action_dim, before.state_dim) != (action_dim, state_dim):
            raise ValueError(f"{state_before.path} has vectors of {before.action_dim} and {before.state_dim} numbers, not {action_dim} and {state_dim}")
    bad = segments.where("n_bad > 0").select(segment, "n_bad", F.lit("vector of another width").alias("reason"))
    kept = side_join(staged, bad.select(segment), [segment], "left_anti", size=size)
    good = segments.where("n_bad = 0").drop("n_bad")
    episodes = numbered(good, segment, "episode_index", known=(n_segments, size), first_index="length")
    if state_before:
        episodes = episodes.withColumns({
            "episode_index": F.col("episode_index") + state_before.n_episodes, "first_index": F.col("first_index") + state_before.n_frames})
    layout = measure(kept, [segment], [ts, seq], target_rows, totals(good, "length"))
    frames = number_frames(kept, episodes, segment=segment, ts=ts, seq=seq, layout=layout, size=2 * size)
    tasks = materialize(task_table(kept, order=(segment, ts, seq), known=state_before.tasks if state_before else None))
    all_tasks = materialize(tasks.unionByName(state_before.tasks)) if state_before else tasks
    frames = side_join(frames, all_tasks, ["task"], "inner", size=table_size(all_tasks)[1])
    # Five counters and the float32 vectors; all rows are of one size, so bytes follow rows.
    row_bytes = 8 * 4 + 4 + 4 * (action_dim + state_dim)
    sized = episodes.withColumns({
        "size_bytes": F.col("length") * F.lit(row_bytes), "bytes_before": F.col("first_index") * F.lit(row_bytes),
    })
    placed = file_places(sized, target_mb=file_mb) if packing == "even" else materialize(
        pack_files(sized, target_bytes=int(file_mb * MB), **(_last_file(state_before) if state_before else {})))
    where = placed.select("episode_index", "chunk_index", "file_index")
    frames = side_join(frames, where, ["episode_index"], "inner", rows=n_segments)
    done = (state_before.n_episodes, state_before.n_frames) if state_before else (0, 0)
    info = placed.agg(
        (F.count(F.lit(1)) + done[0]).alias("total_episodes"),
        (F.coalesce(F.sum("length"), F.lit(0)) + done[1]).alias("total_frames"),
        F.lit(action_dim).alias("action_dim"),
        F.lit(state_dim).alias("state_dim"),
        F.lit(FILES_PER_CHUNK).alias("files_per_chunk"),
    ).crossJoin(all_tasks.agg(F.count(F.lit(1)).alias("total_tasks")))
    if fps is not None:
        rates = side_join(fps, placed.select(segment), [segment], "left_semi").select("fps")
        if state_before and "least_fps" in state_before.info.columns:
            rates = rates.unionByName(state_before.info.select(F.explode(F.array("least_fps", "most_fps")).alias("fps")))
        one = F.when(F.min("fps") == F.max("fps"), F.min("fps"))
        info = info.crossJoin(rates.agg(one.alias("fps"), F.min("fps").alias("least_fps"), F.max("fps").alias("most_fps")))
    found = infer_features(kept, {v: [v] for v in VECTORS}, names=names, keys=[segment], order=(ts, seq))
    if images is not None:
        found = found.unionByName(side_join(images.withColumnRenamed("segment_id", segment), good.select(segment), [segment], "left_semi", size=size))
    return Dataset(
        frames=frames,
        episodes=placed.withColumnRenamed(segment, "segment_id"),
        tasks=tasks,
        rejected=bad,
        info=info,
        features=dataset_features(found, info),
    )


def _last_file(state: DatasetState) -> dict[str, int]:
    """Number and bytes of the file that the next episode may go into."""
    sizes = state.episodes.groupBy(file_number().alias("file")).agg(F.sum("size_bytes").alias("bytes"))
    last = sizes.agg(F.max(F.struct("file", "bytes")).alias("last")).first().last
    return {"first_file": last["file"], "filled": last["bytes"]} if last else {}


def image_features(shapes: DataFrame, *, segment: str = "bag_id", camera: str = "camera", dtype: str = "video") -> DataFrame:
    """Image features per segment from a table of (segment, camera, height, width, channels)."""
    shape = F.array(*[F.col(c).cast("int") for c in ("height", "width", "channels")])
    axes = F.array(F.lit("height"), F.lit("width"), F.lit("channels"))
    return shapes.groupBy(F.col(segment).alias("segment_id"), F.col(camera).alias("camera")).agg(F.min(shape).alias("shape"), F.max(shape).alias("_most")).select(
        "segment_id", F.concat(F.lit("observation.images."), "camera").alias("name"), F.lit(dtype).alias("dtype"), "shape", axes.alias("names"),
        (F.col("shape") == F.col("_most")).alias("usable"))


def dataset_features(found: DataFrame, info: DataFrame) -> DataFrame:
    """What a dataset's columns are: (name, dtype, shape, names): features all segments agree on, then the counters.

    Vector names that do not fit the width are left out; a dataset without rows has the widths of ``info``.
    """
    agreed = agreed_features(found)
    vectors = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("dim")) for n, c in (("action", "action_dim"), ("observation_state", "state_dim"))])
    planned = info.select(F.inline(vectors)).join(agreed.select("name", "shape", "names"), "name", "left")
    widths = planned.select("name", F.lit("float32").alias("dtype"), F.array(F.col("dim").cast("int")).alias("shape"),
                            F.when(F.size("names") == F.col("dim"), F.col("names")).alias("names"))
    images = agreed.where(F.col("agreed") & F.col("dtype").isin("video", "image")).select("name", "dtype", "shape", "names")
    rows = [("timestamp", "float32")] + [(name, "int64") for name in ("frame_index", "episode_index", "index", "task_index")]
    made = [F.struct(F.lit(n).alias("name"), F.lit(t).alias("dtype"), F.array(F.lit(1)).alias("shape"), F.lit(None).cast("array<string>").alias("names")) for n, t in rows]
    return widths.unionByName(images).unionByName(info.select(F.inline(F.array(*made))))


def publish(
    dataset: Dataset, path: str, replace: bool = False, append: bool = False, counts: Mapping[str, int] | None = None, **tables: DataFrame
) -> None:
    """Write frames and metadata tables as one batch, then the version that shows them: episodes, episode_files, tasks,
    episode_tasks, stats, info, features, rejected, and those given by name.

    Statistics, tasks and files per episode are computed from the written frames, so the
    alignment behind them runs once and a recorded path is that of a file that was written.
    A failure at any point leaves what readers see as it was. An existing dataset is refused
    unless it is to be replaced or appended to. ``run_report`` has the frames and episodes that were
    written, counted as they were, and the ``counts`` of the run.
    """
    spark = dataset.frames.sparkSession
    meta = {
        "episodes": dataset.episodes, "tasks": dataset.tasks, "info": dataset.info,
        "rejected": dataset.rejected, **({"features": dataset.features} if dataset.features is not None else {}), **tables,
    }
    mode = "append" if append else "replace" if replace else "new"
    with publishing(spark, path, mode) as batch:
        seen = Observation()
        frames = dataset.frames.observe(
            seen, F.count(F.lit(1)).alias("n_frames"), F.count_if(F.col("frame_index") == 0).alias("n_episodes"))
        write_dataset(frames, meta, path, batch=batch)
        report = {**(counts or {}), **seen.get}
        written = spark.read.schema(dataset.frames.schema).parquet(f"{path}/data/batch={batch}")
        derived = {
            "episode_files": episode_files(spark, path, batch),
            "episode_tasks": episode_tasks(written, episode="episode_index", order=("frame_index",)),
            "stats": stats_arrays(episode_stats(written, VECTORS)),
            "run_report": spark.createDataFrame([tuple(report.values())], ", ".join(f"{name} bigint" for name in report)),
        }
        write_meta(derived, path, batch=batch)


def append_dataset(spark: SparkSession, path: str, rows: DataFrame, action: Sequence[str], state: Sequence[str], **options) -> Dataset:
    """Add the segments of ``rows`` to a published dataset as a further version.

    Two batches published one after the other give the rows of one run over both, if the segments
    of the second come after those of the first. See ``build_dataset`` for the options.
    """
    dataset = build_dataset(rows, action, state, state_before=dataset_state(spark, path), **options)
    publish(dataset, path, append=True)
    return dataset


def camera_clock(frames: DataFrame, anchors: DataFrame, camera: str = "left_eye") -> DataFrame:
    """Frame times of one camera: clock anchor plus presentation time.

    Recordings without an anchor or without such frames have no clock: see ``recording_faults``.
    """
    stream = frames.where(F.col("camera") == camera).select("bag_id", "frame_no", "pts", "tb_num", "tb_den")
    known = anchors.where(F.col("first_frame_epoch_ns").isNotNull())
    joined = side_join(stream, known, ["bag_id"], "inner")
    at = frame_time(F.col("first_frame_epoch_ns"), F.col("pts"), F.col("tb_num"), F.col("tb_den"))
    return joined.select("bag_id", F.col("frame_no").alias("seq"), at.alias("ts_ns"))


def recording_faults(
    bags: DataFrame, anchors: DataFrame, frames: DataFrame, camera: str = "left_eye", cameras: Sequence[str] = ()
) -> DataFrame:
    """A row for every recording (of ``bags``, anchors or frames) with what it lacks: (bag_id, reasons).

    Checked are the clock anchor, frames of the clock camera and of each of ``cameras``, and that
    all cameras a recording has hold as many frames.
    """
    others = [c for c in cameras if c != camera]
    counted = frames.groupBy("bag_id", "camera").agg(F.count(F.lit(1)).alias("n"))
    cameras = counted.groupBy("bag_id").agg(
        F.max(F.col("camera") == camera).alias("_clock"), (F.min("n") < F.max("n")).alias("_uneven"),
        *[F.max(F.col("camera") == c).alias(f"_has{i}") for i, c in enumerate(others)],
    )
    anchored = anchors.groupBy("bag_id").agg(F.max(F.col("first_frame_epoch_ns").isNotNull()).alias("_anchor"))
    every = bags.select("bag_id").unionByName(anchors.select("bag_id")).unionByName(frames.select("bag_id")).distinct()
    found = every.join(anchored, "bag_id", "left").join(cameras, "bag_id", "left")
    no = F.lit(False)
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce("_anchor", no), "no clock anchor"),
        F.when(~F.coalesce("_clock", no), f"no {camera} frames"),
        *[F.when(~F.coalesce(f"_has{i}", no), f"no {c} frames") for i, c in enumerate(others)],
        F.when(F.coalesce("_uneven", no), "cameras differ in length"),
    ))
    return found.select("bag_id", reasons.alias("reasons"))


def _with_reasons(faults: DataFrame, more: DataFrame | None) -> DataFrame:
    """Faults (bag_id, reasons) with further rows (bag_id, reason) added to them; a null recording is one as well."""
    if more is None:
        return faults
    grouped = more.groupBy(F.col("bag_id").alias("_bag")).agg(F.sort_array(F.collect_set("reason")).alias("_more"))
    joined = faults.join(grouped, F.col("bag_id").eqNullSafe(F.col("_bag")), "left")
    return joined.select("bag_id", F.concat("reasons", F.coalesce("_more", F.array().cast("array<string>"))).alias("reasons"))


def component_parts(messages: DataFrame, topics: Collection[str], mode: str) -> DataFrame:
    """Messages of the columns picked per recording and path, with ``part``: the path and the column's position.

    A pose path has up to two parts (translations, then quaternions), the others one; columns
    that were not picked are left out. Quaternions alone are the second part: the first has no
    value then. A message without a component name counts as a column of its own.
    """
    named = messages.where(F.col("entity_path").isin(*topics)).withColumn(
        "column_name", F.concat_ws(":", "entity_path", F.coalesce("component", F.lit("values")))
    )
    wanted = {p: c for p, c in column_preferences(mode).items() if p in topics}
    wanted |= {p: [] for p in topics if p not in wanted}
    presence = named.select("bag_id", "entity_path", "column_name").distinct()
    alone = F.count(F.lit(1)).over(Window.partitionBy("bag_id", "entity_path")) == 1
    turns = F.col("entity_path").isin(*POSE_PATHS) & F.col("column_name").endswith(f":{POSE_COMPONENTS[1]}")
    picked = pick_columns(presence, wanted).withColumn("position", F.when(alone & turns, F.lit(1)).otherwise(F.col("position")))
    joined = side_join(named, picked, ["bag_id", "entity_path", "column_name"], "inner")
    part = F.concat_ws("#", "entity_path", F.col("position").cast("string"))
    return joined.withColumn("part", part).drop("position", "column_name")


def align_recordings(
    clock: DataFrame,
    messages: DataFrame,
    topics: Mapping[str, str],
    widths: Mapping[str, int],
    *,
    mode: str,
    text_path: str | None = TEXT_PATH,
    target_rows: int | None = None,
) -> AlignedBags:
    """Every path on the camera clock as one vector, and the instruction text.

    The picked columns of a path are aligned each by itself, then joined end to end and padded
    to the path's width (never cut). The first column of a pose path holds at least a translation's
    three numbers, so that the second always starts behind them. ``status.reasons`` names paths
    without a value (for a pose also: without translations or scalars) and paths wider than their width.
    """
    two = [p for p in topics if p in POSE_PATHS]
    parts = {f"{p}#{i}": f"{c}__{i}" for p, c in topics.items() for i in range(2 if p in two else 1)}
    values = component_parts(messages, list(topics), mode).select("bag_id", "part", "ts_ns", "seq", "values", F.lit(None).cast("string").alias("text"))
    texts = {}
    if text_path:
        texts = {text_path: "task_text"}
        words = messages.where(F.col("entity_path") == text_path).select(
            "bag_id", F.col("entity_path").alias("part"), "ts_ns", "seq", F.lit(None).cast("array<double>").alias("values"), "text")
        values = values.unionByName(words)
    aligned = align_bags(
        clock, values, parts, {f"{p}#0": TRANSLATION for p in two}, topic="part", optional=[f"{p}#1" for p in two], texts=texts, stage=True,
        target_rows=target_rows,
    )
    joined = {}
    for p, c in topics.items():
        whole = F.concat(*[F.col(parts[f"{p}#{i}"]) for i in range(2 if p in two else 1)])
        joined[c] = pad_vector(whole, F.greatest(F.size(whole), F.lit(widths.get(p, 0))))
    frames = aligned.frames.select("bag_id", "ts_ns", "seq", *[v.alias(c) for c, v in joined.items()], *texts.values())
    wide = [
        F.when(
            sum((F.col("widths")[f"{p}#{i}"] for i in range(2 if p in two else 1)), F.lit(0)) > widths[p],
            F.lit(f"vector of another width: {p}"),
        )
        for p in topics if p in widths
    ]
    empty = F.transform("empty_topics", lambda t: F.concat(F.lit("no value: "), F.substring_index(t, "#", 1)))
    status = aligned.status.select("bag_id", "n_frames", F.concat(empty, F.array_compact(F.array(*wide))).alias("reasons"))
    return AlignedBags(frames, status)


def run_tables(
    bags: DataFrame,
    anchors: DataFrame,
    frames: DataFrame,
    messages: DataFrame,
    output: str,
    *,
    mode: str = "gripper",
    strict: bool = False,
    replace: bool = True,
    topics: Mapping[str, str] | None = None,
    widths: Mapping[str, int] | None = None,
    action: Sequence[str] | None = None,
    action_dim: int = 42,
    text_path: str | None = TEXT_PATH,
    reports: Mapping[str, DataFrame] | None = None,
    target_rows: int | None = None,
    cameras: Sequence[str] = (),
    target_fps: float | None = None,
    known_faults: DataFrame | None = None,
    **options,
) -> Dataset:
    """Recordings as tables to a published dataset: clock, alignment, episodes, files.

    ``meta/status`` has a row for every recording that ``bags``, anchors, frames or messages
    name, with the reasons why it is not in the dataset. With ``strict`` any such reason fails
    the run before anything is published. ``meta/dim_mismatch`` lists the paths whose messages
    do not have the contract's width, with a sample; ``reports`` are published beside it.

    Further reasons: a camera of ``cameras`` without frames, a clock that does not run at
    ``target_fps`` within the tolerance, and the rows (bag_id, reason) of ``known_faults``.
    """
    widths = widths if widths is not None else STATE_WIDTHS[mode]
    topics = topics or {p: p.strip("/").replace("/", "_") for p in source_paths(mode)}
    named = bags.select("bag_id").unionByName(messages.select("bag_id")).distinct()
    if known_faults is not None:
        named = named.unionByName(known_faults.select("bag_id")).distinct()
    faults = materialize(_with_reasons(recording_faults(named, anchors, frames, cameras=cameras), known_faults))
    sound = faults.where(F.size("reasons") == 0).select("bag_id")
    clock = write_once(side_join(camera_clock(frames, anchors), sound, ["bag_id"], "left_semi"))
    if target_fps is not None:
        rated = fps_check(clock, ["bag_id"], target_fps, target_rows=target_rows)
        off = rated.where("NOT keeps_rate").select("bag_id", F.lit(f"clock does not run at {float(target_fps):g} frames a second").alias("reason"))
        faults = materialize(_with_reasons(faults, off))
        sound = faults.where(F.size("reasons") == 0).select("bag_id")
        clock = side_join(clock, sound, ["bag_id"], "left_semi")
    aligned = align_recordings(
        clock, messages, topics, widths, mode=mode, text_path=text_path, target_rows=target_rows
    )
    status, counts = write_counted(
        faults.withColumnRenamed("reasons", "_f").join(aligned.status, "bag_id", "left").select(
            "bag_id", F.concat("_f", F.coalesce("reasons", F.array().cast("array<string>"))).alias("reasons"),
        ).withColumn("ok", F.size("reasons") == 0),
        **report_metrics(),
    )
    require(counts, strict)
    usable = side_join(aligned.frames, status.where("ok").select("bag_id"), ["bag_id"], "left_semi")
    action = list(action or [topics[p] for p in topics if p not in widths])
    state = [topics[p] for p in topics if p in widths]
    dataset = build_dataset(
        usable, action, state, segment="bag_id", action_dim=action_dim, state_dim=sum(widths.values()),
        task="task_text" if text_path else None, fps=infer_fps(clock, ["bag_id"], target_rows=target_rows),
        target_rows=target_rows, **options,
    )
    if strict and not dataset.rejected.isEmpty():
        raise RuntimeError("recordings with vectors of another width")
    odd = dim_mismatch(messages.select("bag_id", "entity_path", "component", "ts_ns", "seq", "values"), widths)
    publish(dataset, output, replace, counts=counts, status=status, dim_mismatch=odd, **(reports or {}))
    return dataset


def run_full(
    spark: SparkSession,
    bag_root: str,
    messages_path: str,
    frames_path: str,
    output: str,
    *,
    timeline: str | None = None,
    fmt: str = "parquet",
    strict: bool = False,
    **options,
) -> None:
    """Recordings below ``bag_root`` (anchor files), a message log and camera frames to a published dataset.

    Messages are placed by the preferred timeline of their recording, or by ``timeline`` if one
    is named; those without any are reported like the other faults. ``fmt`` is the log's format: in
    JSON or CSV a record that cannot be read is counted in ``meta/ingest_report`` and rejects its
    recording. With ``strict`` a required input file that is missing fails the run as well. What the
    job staged is removed at the end. See ``run_tables`` for the options.
    """
    with discard_staged(spark):
        files = list_files(spark, bag_root)
        bags = in_bags(files).select("bag_id").distinct()
        missing = materialize(missing_files(files))
        if strict:
            lacking = [f"{r.bag_id}/{r.name}" for r in missing.limit(3).collect()]
            if lacking:
                raise RuntimeError(f"recordings would be rejected for missing inputs: {', '.join(lacking)}")
        read = read_messages(spark, messages_path, fmt=fmt)
        # Text records are read once; whether one is malformed and what it says come from that table.
        read = read if fmt == "parquet" else write_once(read)
        ingested = materialize(ingest_report(read))
        malformed = ingested.where("NOT ok").select("bag_id", F.lit("malformed records").alias("reason"))
        messages = parsed(read)
        columns = {timeline: timeline_columns()[timeline]} if timeline else timeline_columns()
        placed = reindex_timeline(messages, columns)
        named = bags.unionByName(messages.select("bag_id")).distinct()
        run_tables(
            named, read_anchors(spark, bag_root, strict=False), read_frames(spark, frames_path), placed, output, strict=strict,
            reports={"missing_inputs": missing, "ingest_report": ingested}, known_faults=malformed, **options,
        )
