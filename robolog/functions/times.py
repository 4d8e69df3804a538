"""Column functions for clocks, names that carry time, and task text.

Time keys are BIGINT nanoseconds throughout; TIMESTAMP holds only microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F, types as T

from robolog.contracts import BAG_PREFIX, DEFAULT_TASK, NS, STAMP_FORMAT


def ntz_micros(value: Column) -> Column:
    """Epoch microseconds of a zone-less timestamp read as UTC, in any session time zone."""
    zone = SparkSession.active().conf.get("spark.sql.session.timeZone")
    if zone in ("UTC", "Etc/UTC", "GMT", "Z"):
        return F.unix_micros(value.cast("timestamp"))
    million = F.lit(1_000_000).cast("bigint")
    day = F.unix_date(value.cast("date")).cast("bigint") * 86_400
    clock = F.hour(value) * 3600 + F.minute(value) * 60
    second = F.extract(F.lit("SECOND"), value) * million  # decimal, exact
    return (day + clock) * million + second.cast("bigint")


def normalize_time(value: Column, dtype: T.DataType) -> Column:
    """Epoch nanoseconds from a timestamp, an interval, float seconds or an integer."""
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(value) * F.lit(1000).cast("bigint")
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return F.unix_micros(value.cast("timestamp")) * F.lit(1000).cast("bigint")
    if isinstance(dtype, T.DayTimeIntervalType):
        seconds = F.extract(F.lit("DAY"), value) * 86400 + F.extract(F.lit("HOUR"), value) * 3600
        seconds = seconds + F.extract(F.lit("MINUTE"), value) * 60
        exact = F.extract(F.lit("SECOND"), value) * NS  # decimal seconds, exact
        return seconds.cast("bigint") * NS + exact.cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (value.cast("double") * F.lit(float(NS))).cast("bigint")
    return value.cast("bigint")


def frame_time(anchor_ns: Column, pts: Column, num: Column, den: Column) -> Column:
    """Clock anchor plus presentation time ``pts * num / den`` in whole nanoseconds."""
    ticks = pts.cast("decimal(38,0)") * num.cast("decimal(10,0)") * F.lit(NS)
    return anchor_ns + F.call_function("div", ticks, den.cast("decimal(10,0)")).cast("bigint")


# How the anchor stands in its file: in an indented block or in braces.
ANCHOR_BLOCK = r"(?m)^first_frame_time[ \t]*:[ \t]*(?:#.*)?\r?\n(?:[ \t]+.*\r?\n|\r?\n)*?[ \t]+epoch_ns[ \t]*:[ \t]*['\"]?(-?\d+)"
ANCHOR_BRACES = r"(?m)^first_frame_time[ \t]*:[ \t]*\{[^}]*?\bepoch_ns['\"]?[ \t]*:[ \t]*['\"]?(-?\d+)"


def anchor_from_text(text: Column) -> Column:
    """``epoch_ns`` below ``first_frame_time`` in a clock-anchor file; null when missing."""
    found = [F.regexp_extract(text, p, 1).try_cast("bigint") for p in (ANCHOR_BLOCK, ANCHOR_BRACES)]
    return F.coalesce(*found)


def bag_timestamp(name: Column, prefix: str = BAG_PREFIX) -> Column:
    """The part of a recording name after the prefix, else the whole name."""
    return F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 2**31 - 1)).otherwise(name)


def name_timestamp(name: Column, prefix: str, suffix: str) -> Column:
    """The part of a file name between prefix and suffix; null when it does not match."""
    body = F.regexp_extract(name, f"^\\Q{prefix}\\E(.+)\\Q{suffix}\\E$", 1)
    return F.nullif(body, F.lit(""))


def parse_bag_timestamp(stamp: Column) -> Column:
    """``yy-MM-dd-HH-mm-ss`` as a zone-less timestamp, null when it is something else."""
    return F.try_to_timestamp(stamp, F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def task_text(
    text: Column,
    dtype: T.DataType,
    default: str = DEFAULT_TASK,
    override: str | None = None,
) -> Column:
    """Task of a frame: the override, else the text (UTF-8 bytes are decoded), else default."""
    if override is not None:
        return F.lit(override)
    if isinstance(dtype, T.ArrayType):
        return task_text(F.get(text, F.lit(0)), dtype.elementType, default)
    if isinstance(dtype, T.BinaryType):
        text = F.decode(text, "UTF-8")
    return F.coalesce(text.cast("string"), F.lit(default))
