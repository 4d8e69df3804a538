"""Whole-recording alignment jobs: sensors, images and joints on the camera clock."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from robolog.contracts import ARM_JOINTS, IMAGE_PATH
from robolog.functions.numeric import pad_vector
from robolog.operators.align import asof_align, asof_pointer, fetch
from robolog.operators.images import image_codec, with_media_type
from robolog.operators.joins import side_join
from robolog.operators.joints import joint_pose, unpivot_joints
from robolog.operators.select import pick_image_columns
from robolog.session import materialize, write_once


@dataclass(frozen=True)
class AlignedBags:
    """Aligned frames of the good recordings, and a status row for every recording of the clock.

    ``status`` has the recording, n_frames, empty_topics, ok, and ``widths`` (topic to width).
    """

    frames: DataFrame
    status: DataFrame


def align_bags(
    clock: DataFrame,
    messages: DataFrame,
    topics: Mapping[str, str],
    targets: Mapping[str, int] | None = None,
    *,
    bag: str = "bag_id",
    topic: str = "entity_path",
    ts: str = "ts_ns",
    seq: str = "seq",
    value: str = "values",
    missing: str = "zero",
    optional: Collection[str] = (),
    texts: Mapping[str, str] | None = None,
    text: str = "text",
    stage: bool = True,
    target_rows: int | None = None,
) -> AlignedBags:
    """Every topic on the camera clock as a float32 vector of constant width per recording.

    The width of a topic is its longest aligned vector, at least the target. Frames before
    a topic's first message get zeros (``missing='zero'``) or are left out (``'drop'``). A
    recording where some topic never has a value is rejected, unless the topic is ``optional``;
    its vectors are then empty. ``texts`` maps topics whose payload is the column ``text`` to
    their output; they go through the same scan and may be null. All recordings go through one
    job; the per-recording profile (widths, counts) is the only extra table. The aligned
    rows are needed for the profile and for the result: they are written once to the shared
    folder and read twice; without ``stage`` the join runs twice.
    """
    if missing not in ("zero", "drop"):
        raise ValueError(f"unknown missing policy {missing}")
    targets, texts = targets or {}, texts or {}
    aligned = asof_align(
        clock, messages, {**topics, **texts}, bag=bag, topic=topic, ts=ts, seq=seq,
        value={**dict.fromkeys(topics, value), **dict.fromkeys(texts, text)}, target_rows=target_rows,
    )
    if stage:
        aligned = write_once(aligned)
    columns = list(topics.values())
    profile = materialize(
        aligned.groupBy(bag).agg(
            F.count(F.lit(1)).alias("n_frames"),
            *[F.count(c).alias(f"_c_{c}") for c in columns],
            *[F.coalesce(F.max(F.size(c)), F.lit(0)).alias(f"_w_{c}") for c in columns],
        )
    )
    empty = F.array_compact(
        F.array(*[
            F.when(F.col(f"_c_{c}") == 0, F.lit(p)) if p not in optional else F.lit(None).cast("string")
            for p, c in topics.items()
        ])
    )
    width = {
        c: F.greatest(F.col(f"_w_{c}"), F.lit(0 if p in optional else max(1, targets.get(p, 1))))
        for p, c in topics.items()
    }
    widths = F.map_from_arrays(F.array(*[F.lit(p) for p in topics]), F.array(*[width[c] for c in columns]))
    status = profile.select(bag, "n_frames", empty.alias("empty_topics"), widths.alias("widths")).withColumn(
        "ok", F.size("empty_topics") == 0
    )
    good = profile.where(F.size(empty) == 0).select(bag, *[width[c].alias(f"_w_{c}") for c in columns])
    rows = aligned.dropna(subset=columns) if missing == "drop" else aligned
    joined = side_join(rows, good, [bag], "inner")
    frames = joined.select(
        *clock.columns, *[pad_vector(F.col(c), F.col(f"_w_{c}")).alias(c) for c in columns], *texts.values()
    )
    return AlignedBags(frames, status)


def align_images(
    clock: DataFrame,
    images: DataFrame,
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    hint: str = "encoding",
    blob: str = "blob",
    column: str | None = None,
    path: str = IMAGE_PATH,
    target_rows: int | None = None,
) -> DataFrame:
    """An encoded image topic on the camera clock, with its media type.

    Frames without an image repeat the last one; before the first the bytes are empty. With
    ``column`` (the name of the column a row's payload came from) each recording's image
    column and codec column of ``path`` are picked first: only the former's images count, and
    only the latter's encodings. The clock is pointed to images by their keys; the bytes are
    moved once, to the frames that show them.
    """
    if column:
        picked = pick_image_columns(images.select(bag, column).distinct(), path, bag=bag, column=column)
        known = side_join(images, picked, [bag], "inner")
        images = known.withColumns({
            blob: F.when(F.col(column) == F.col("image_column"), F.col(blob)),
            hint: F.when(F.col(column) == F.coalesce("codec_column", "image_column"), F.col(hint)),
        }).drop("image_column", "codec_column")
    pointed = asof_pointer(
        clock, images, F.octet_length(blob) > 0, bag=bag, ts=ts, seq=seq, target_rows=target_rows
    )
    codecs = image_codec(images, bag=bag, order=(ts, seq), hint=hint, blob=blob)
    shown = fetch(pointed, images.where(F.octet_length(blob) > 0), [blob], bag=bag, ts=ts, seq=seq)
    return with_media_type(shown.withColumn(blob, F.coalesce(blob, F.lit(b""))), codecs, bag=bag)


def aligned_joints(
    clock: DataFrame,
    positions: DataFrame,
    axes: Mapping[str, tuple[float, float, float]],
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    value: str = "values",
    target_rows: int | None = None,
) -> DataFrame:
    """Arm joints on the left-eye clock: a row per frame and joint with angle and rotation.

    Recordings whose position vectors have fewer numbers than the arm has joints fail the
    query. Frames before the first message have angle 0.
    """
    missing = [j for j in ARM_JOINTS if j not in axes]
    if missing:
        raise ValueError(f"joint table lacks {missing}")
    tagged = positions.withColumn("_topic", F.lit("position"))
    aligned = asof_align(
        clock, tagged, {"position": "position"}, bag=bag, topic="_topic", ts=ts, seq=seq,
        value=value, target_rows=target_rows,
    )
    # Read for the widths and for the result.
    aligned = write_once(aligned)
    n = len(ARM_JOINTS)
    widest = aligned.groupBy(bag).agg(F.max(F.size("position")).alias("_widest"))
    checked = side_join(aligned, widest, [bag], "left")
    enough = F.coalesce(F.col("_widest"), F.lit(0)) >= n
    problem = F.concat(F.lit(f"fewer than {n} joint values in "), F.col(bag).cast("string"))
    vector = F.when(enough, pad_vector(F.col("position"), n)).otherwise(
        F.raise_error(problem).cast("array<float>")
    )
    vectors = checked.withColumn("position", vector).drop("_widest")
    keep = [c for c in clock.columns]
    return joint_pose(unpivot_joints(vectors, "position", keep), axes)
