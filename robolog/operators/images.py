"""Encoded image topics, packets and tiled frames as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from robolog.functions import images as img
from robolog.operators.joins import side_join
from robolog.operators.layout import BLOB_ROWS, Layout, measure
from robolog.operators.align import asof_pointer, fetch
from robolog.operators.scan import last_value, row_number, running_sum, scan
from robolog.session import write_once


def image_codec(
    df: DataFrame,
    *,
    bag: str = "bag_id",
    order: Sequence[str] = ("ts_ns", "seq"),
    hint: str = "encoding",
    blob: str = "blob",
) -> DataFrame:
    """Codec per recording: the first non-blank encoding name if it names an image codec,
    else the signature of the first non-empty image, else jpeg."""
    position = F.struct(*order)
    named = F.when(F.trim(F.col(hint)) != "", position)
    filled = F.when(F.octet_length(blob) > 0, position)
    head = F.substring(F.col(blob), 1, 12)
    firsts = df.groupBy(bag).agg(
        F.min_by(hint, named).alias("_name"), F.min_by(head, filled).alias("_head")
    )
    codec = F.coalesce(img.codec_from_name(F.col("_name")), img.codec_from_bytes(F.col("_head")))
    return firsts.select(bag, codec.alias("codec"))


def carry_forward(
    df: DataFrame,
    *,
    bag: str = "bag_id",
    order: Sequence[str] = ("ts_ns", "seq"),
    blob: str = "blob",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Repeat the last non-empty image where one is missing; empty bytes before the first.

    The scan carries the position of the last image, not its bytes; rows that have an image
    keep it, the others are joined to the one they point to. ``order`` tells rows apart.
    """
    order = list(order)
    filled = F.octet_length(blob) > 0
    if layout is None:
        layout = measure(df, [bag], order, target_rows)
    keys = df.select(bag, *order, F.when(filled, F.struct(*order)).alias("_here"))
    pointed = scan(keys, [bag], order, layout, _last=last_value("_here"))
    missing = pointed.where("_here IS NULL AND _last IS NOT NULL").select(
        bag, *order, *[F.col("_last")[c].alias(f"_at_{c}") for c in order]
    )
    source = df.where(filled).select(bag, *[F.col(c).alias(f"_at_{c}") for c in order], F.col(blob).alias("_shown"))
    shown = missing.join(source, [bag, *[f"_at_{c}" for c in order]]).select(bag, *order, "_shown")
    joined = df.join(shown, [bag, *order], "left")
    image = F.when(filled, F.col(blob)).otherwise(F.coalesce("_shown", F.lit(b"")))
    return joined.withColumn(blob, image).select(*df.columns)


def concat_packets(
    df: DataFrame,
    *,
    stream: str = "stream",
    order: Sequence[str] = ("ts_ns", "seq"),
    packet: str = "packet",
    part_bytes: int = 4 * 1024 * 1024,
    layout: Layout | None = None,
    target_rows: int | None = BLOB_ROWS,
) -> DataFrame:
    """The bytes of each stream in order, as parts of about ``part_bytes``.

    Parts in order make the whole stream; a value per part keeps every group bounded,
    whatever the length of the stream. A task holds many parts while it aggregates, so they are small. A packet belongs to the part it starts in, so a part
    is at most one packet longer than the limit.
    """
    sized = df.where(F.octet_length(packet) > 0).withColumn(
        "_size", F.octet_length(packet).cast("bigint")
    )
    placed = scan(sized, [stream], order, layout, target_rows, _upto=running_sum("_size"))
    parts = placed.withColumn("part", F.expr(f"(_upto - _size) DIV {part_bytes}"))
    by = ", ".join(f"`{c}`" for c in [*order, packet])
    return parts.groupBy(stream, "part").agg(
        F.expr(f"listagg(`{packet}`) WITHIN GROUP (ORDER BY {by})").alias("data"), F.count(F.lit(1)).alias("n_packets")
    )


def video_shape(
    frames: DataFrame,
    *,
    keys: Sequence[str] = ("bag_id", "camera"),
    order: Sequence[str] = ("ts_ns", "seq"),
    sample: str = "sample",
    shape: Sequence[str] = ("height", "width", "channels"),
) -> DataFrame:
    """Frame shape of each stream, from the header fields of its first sample."""
    at = F.when(F.col(sample).isNotNull(), F.struct(*order))
    first = frames.groupBy(*keys).agg(F.min_by(F.struct(*shape), at).alias("_s"))
    return first.select(*keys, *[F.col("_s")[c].alias(c) for c in shape])


def tile_geometry(frames: DataFrame, *, width: str = "width", height: str = "height") -> DataFrame:
    """The four camera windows of every frame size, frames under 2 x 2 left out."""
    big = frames.where((F.col(width) >= 2) & (F.col(height) >= 2))
    return big.select("*", F.inline(img.tiles(F.col(width), F.col(height))))


def tile_crop(
    frames: DataFrame,
    *,
    pixels: str = "pixels",
    width: str = "width",
    height: str = "height",
    channels: str = "channels",
) -> DataFrame:
    """Each frame cut into its four camera images."""
    windows = tile_geometry(frames, width=width, height=height)
    cut = img.crop(
        F.col(pixels), F.col(width), F.col(channels), F.col("r0"), F.col("r1"), F.col("c0"), F.col("c1")
    )
    return windows.withColumn("tile", cut).drop(pixels)


def with_media_type(df: DataFrame, codecs: DataFrame, *, bag: str = "bag_id") -> DataFrame:
    """Add the codec and media type of the recording to its images."""
    joined = side_join(df, codecs, [bag], "left")
    return joined.withColumn("media_type", img.media_type(F.col("codec")))


def packet_groups(
    packets: DataFrame,
    *,
    stream: str = "stream",
    ts: str = "ts_ns",
    seq: str = "seq",
    packet: str = "packet",
    codec: str = "h264",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Every packet's number in its stream from 0 and its group: (stream, ts, seq, packet_no, is_key, group_no).

    A group begins with a key packet; packets before the first are group 0. Payloads are looked at where
    they are read and go no further.
    """
    marks = packets.select(stream, ts, seq, img.is_key_packet(F.col(packet), codec).cast("int").alias("_key"))
    if layout is None:
        layout = measure(packets.select(stream, ts, seq), [stream], [ts, seq], target_rows)
    numbered = scan(marks, [stream], [ts, seq], layout, _n=row_number(), _group=running_sum("_key"))
    return numbered.select(
        stream, ts, seq, (F.col("_n") - 1).alias("packet_no"), (F.col("_key") == 1).alias("is_key"), F.col("_group").cast("bigint").alias("group_no"))


def frame_packets(
    wanted: DataFrame,
    packets: DataFrame,
    *,
    stream: str = "stream",
    ts: str = "ts_ns",
    seq: str = "seq",
    packet: str = "packet",
    codec: str = "h264",
    target_rows: int | None = None,
) -> DataFrame:
    """The packets a decoder needs to show the frames at the wanted times: (stream, ts, seq, packet_no, group_no, shown).

    The frame shown at a time is the latest packet then, or the first packet before all of them. It needs
    every packet from its group's key packet on. Two such ranges overlap only within a group, where the
    longer holds the shorter, so overlapping ranges are one range per group, and the packets are found by
    equality on the group. ``shown`` counts the wanted times that show the packet itself; a packet that
    several frames need is there once. Nothing is decoded.
    """
    groups = packet_groups(packets, stream=stream, ts=ts, seq=seq, packet=packet, codec=codec, target_rows=target_rows)
    groups = write_once(groups)
    pointed = asof_pointer(wanted, groups, F.lit(True), bag=stream, ts=ts, seq=seq, clamp=True, target_rows=target_rows)
    found = fetch(pointed, groups, ["packet_no", "group_no"], bag=stream, ts=ts, seq=seq).where("packet_no IS NOT NULL")
    frames = write_once(found.groupBy(stream, "group_no", "packet_no").agg(F.count(F.lit(1)).alias("shown")))
    ranges = frames.groupBy(stream, "group_no").agg(F.max("packet_no").alias("_last"))
    needed = side_join(groups, ranges, [stream, "group_no"], "inner").where("packet_no <= _last")
    shown = needed.join(frames, [stream, "group_no", "packet_no"], "left")
    return shown.select(stream, ts, seq, "packet_no", "group_no", F.coalesce("shown", F.lit(0)).alias("shown"))
