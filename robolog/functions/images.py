"""Column functions for encoded images, raw frames and tile geometry."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Codec names, file signatures and media types.
MEDIA_TYPES = {"jpeg": "image/jpeg", "png": "image/png", "webp": "image/webp"}
OTHER_MEDIA_TYPE = "application/octet-stream"
NAME_HINTS = {
    "jpeg": ["jpeg", "jpg"],
    "png": ["png"],
    "webp": ["webp"],
    "h264": ["h264", "avc", "x264", "mp4"],
}
JPEG_MAGIC = b"\xff\xd8\xff"
PNG_MAGIC = b"\x89PNG\r\n\x1a\n"
RIFF_MAGIC = b"RIFF"
WEBP_MAGIC = b"WEBP"
ANNEXB_MAGICS = [b"\x00\x00\x00\x01", b"\x00\x00\x01"]
BYTE_KEYS = ["data", "blob", "image", "payload"]
BASE64_PATTERN = r"^[A-Za-z0-9+/=\n\r ]+$"
# End of fixed values.


def text_bytes(text: Column) -> Column:
    """Bytes of a string: decoded if it is base64, else its UTF-8 form."""
    trimmed = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    looks_encoded = trimmed.rlike(BASE64_PATTERN) & (F.length(trimmed) % 4 == 0)
    decoded = F.when(looks_encoded, F.try_to_binary(trimmed, F.lit("base64")))
    return F.coalesce(decoded, F.encode(trimmed, "UTF-8"))


def image_bytes(value: Column, dtype: T.DataType) -> Column:
    """Raw bytes out of any stored form; null when there are none.

    Built from the column type: binary as is, strings through ``text_bytes``, structs by
    their ``data``, ``blob``, ``image`` or ``payload`` member (else the first member that
    has bytes), lists of 0..255 as bytes.
    """
    return _nonempty(_any_bytes(value, dtype))


def _nonempty(data: Column) -> Column:
    return F.when(F.octet_length(data) > 0, data)


def _any_bytes(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return value
    if isinstance(dtype, T.StringType):
        return text_bytes(value)
    if isinstance(dtype, T.StructType):
        for key in BYTE_KEYS:
            if key in dtype.names:
                return _any_bytes(value.getField(key), dtype[key].dataType)
        parts = [_nonempty(_any_bytes(value.getField(f.name), f.dataType)) for f in dtype.fields]
        return F.coalesce(*parts, F.lit(None).cast("binary"))
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.IntegralType):
            is_bytes = F.forall(value, lambda x: x.between(0, 255)) & (F.size(value) > 0)
            digits = F.transform(value, lambda x: F.lpad(F.hex(x.cast("bigint")), 2, "0"))
            return F.when(is_bytes, F.unhex(F.array_join(digits, "")))
        found = F.filter(
            F.transform(value, lambda v: _nonempty(_any_bytes(v, dtype.elementType))),
            lambda b: b.isNotNull(),
        )
        return F.get(found, F.lit(0))
    return F.lit(None).cast("binary")


def codec_from_name(name: Column) -> Column:
    """Codec named in an encoding string, null for anything that is no image codec."""
    lowered = F.lower(name)
    chosen = F.lit(None).cast("string")
    for codec, hints in reversed(NAME_HINTS.items()):
        hit = F.lit(False)
        for hint in hints:
            hit = hit | lowered.contains(hint)
        chosen = F.when(hit, F.lit(codec)).otherwise(chosen)
    return chosen


def codec_from_bytes(data: Column) -> Column:
    """Codec by file signature; jpeg when nothing matches."""
    annexb = F.lit(False)
    for magic in ANNEXB_MAGICS:
        annexb = annexb | F.startswith(data, F.lit(magic))
    webp = F.startswith(data, F.lit(RIFF_MAGIC)) & (F.substring(data, 9, 4) == F.lit(WEBP_MAGIC))
    guess = (
        F.when(F.startswith(data, F.lit(JPEG_MAGIC)), "jpeg")
        .when(F.startswith(data, F.lit(PNG_MAGIC)), "png")
        .when(webp, "webp")
        .when(annexb, "h264")
    )
    return F.coalesce(guess, F.lit("jpeg"))


def media_type(codec: Column) -> Column:
    """Media type of a codec."""
    chosen = F.lit(OTHER_MEDIA_TYPE)
    for name, media in MEDIA_TYPES.items():
        chosen = F.when(codec == name, F.lit(media)).otherwise(chosen)
    return chosen


def tiles(width: Column, height: Column) -> Column:
    """The four camera windows of a 2x2 tiled frame, as an array of structs.

    Halves are rounded down; the right and bottom windows keep the odd pixel.
    """
    half_w, half_h = F.floor(width / 2), F.floor(height / 2)
    zero = F.lit(0)

    def window(name: str, r0: Column, r1: Column, c0: Column, c1: Column) -> Column:
        bounds = dict(r0=r0, r1=r1, c0=c0, c1=c1)
        return F.struct(
            F.lit(name).alias("camera"), *[v.cast("bigint").alias(k) for k, v in bounds.items()]
        )

    return F.array(
        window("left_eye", zero, half_h, zero, half_w),
        window("right_eye", zero, half_h, half_w, width),
        window("left_wrist", half_h, height, zero, half_w),
        window("right_wrist", half_h, height, half_w, width),
    )


def crop(pixels: Column, width: Column, channels: Column, r0, r1, c0, c1) -> Column:
    """Bytes of a window of a row-major frame, row slices joined in one pass."""
    start = (F.lit(0) + c0) * channels
    length = ((c1 - c0) * channels).cast("int")
    rows = F.when((r1 > r0) & (c1 > c0), F.sequence(r0, r1 - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    parts = F.transform(
        rows,
        lambda r: F.hex(F.substring(pixels, (r * width * channels + start + 1).cast("int"), length)),
    )
    return F.unhex(F.array_join(parts, ""))


def inner_bounds(size: Column, start_ratio: float, end_ratio: float) -> Column:
    """Start and end after trimming both sides by a ratio, keeping at least one pixel."""
    raw_start = F.floor(size * F.lit(start_ratio))
    raw_end = size - F.floor(size * F.lit(end_ratio))
    start = F.greatest(F.lit(0), F.least(raw_start, size - 1))
    end = F.greatest(start + 1, F.least(raw_end, size))
    return F.struct(start.cast("bigint").alias("first"), end.cast("bigint").alias("end"))


# The first byte of the units that begin a picture which needs no other, after a start code.
KEY_UNITS = {"h264": r"[\x05\x25\x45\x65]", "h265": r"[\x20-\x2B]"}


def is_key_packet(packet: Column, codec: str = "h264") -> Column:
    """Whether a packet of start-coded units holds a picture that is decoded by itself; false for none and for empty ones."""
    if codec not in KEY_UNITS:
        raise ValueError(f"no key units known for {codec}")
    # In ISO-8859-1 every byte is one character.
    text = F.decode(packet.cast("binary"), "ISO-8859-1")
    return F.coalesce(text.rlike(r"\x00\x00\x01" + KEY_UNITS[codec]), F.lit(False))
