"""Aligning topics to a clock: latest-at joins, exact joins with fills, lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from robolog.functions.times import ntz_micros
from robolog.operators.joins import side_join
from robolog.operators.layout import Layout, measure, totals
from robolog.operators.quality import stream_length_mismatch
from robolog.operators.scan import last_value, next_value, row_number, scan
from robolog.session import materialize

CLOCK = "_clock"


def _one_column_per_topic(topic: str, value: str | Mapping[str, str], topics: Mapping[str, str]) -> list[Column]:
    return [
        F.when(F.col(topic) == path, F.col(value if isinstance(value, str) else value[path])).alias(out)
        for path, out in topics.items()
    ]


def latest_on_clock(
    rows: DataFrame,
    bag: str,
    ts: str,
    seq: str,
    columns: Sequence[str],
    layout: Layout | None,
    target_rows: int | None,
) -> DataFrame:
    """Latest non-null value of each column, kept on the clock rows."""
    outputs = {f"_at_{c}": last_value(c) for c in columns}
    filled = scan(rows, [bag], [ts, CLOCK, seq], layout, target_rows, **outputs)
    kept = [c for c in rows.columns if c != CLOCK and c not in columns]
    return filled.where(F.col(CLOCK) == 1).select(
        *kept, *[F.col(f"_at_{c}").alias(c) for c in columns]
    )


def asof_align(
    clock: DataFrame,
    messages: DataFrame,
    topics: Mapping[str, str],
    *,
    bag: str = "bag_id",
    topic: str = "entity_path",
    ts: str = "ts_ns",
    seq: str = "seq",
    value: str | Mapping[str, str] = "value",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """For each clock row, the latest message of every topic at or before it.

    ``topics`` maps an entity path to its output column, ``value`` is the payload column (or
    one for each topic). A message at the same instant counts, the higher ``seq`` wins among
    equal times, and a null payload is no message. Payloads travel with the rows; large ones
    are better pointed to (``asof_pointer``). Clock and messages go through one exchange and one sort for all topics together; there
    is no inequality join. All columns of ``clock`` are kept.
    """
    ticks = clock.withColumn(CLOCK, F.lit(1))
    if seq not in clock.columns:
        ticks = ticks.withColumn(seq, F.lit(0).cast("bigint"))
    columns = _one_column_per_topic(topic, value, topics)
    notes = messages.where(F.col(topic).isin(*topics)).select(bag, ts, seq, *columns)
    some = F.lit(False)
    for c in topics.values():
        some = some | F.col(c).isNotNull()
    notes = notes.where(some).withColumn(CLOCK, F.lit(0))
    rows = ticks.unionByName(notes, allowMissingColumns=True)
    out = latest_on_clock(rows, bag, ts, seq, list(topics.values()), layout, target_rows)
    return out.select(*clock.columns, *topics.values())


def asof_align_log(
    log: DataFrame,
    clock_topic: str,
    topics: Mapping[str, str],
    *,
    bag: str = "bag_id",
    topic: str = "entity_path",
    ts: str = "ts_ns",
    seq: str = "seq",
    value: str = "value",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """``asof_align`` for a clock that is itself a topic of the log: the log is read once."""
    rows = log.where(F.col(topic).isin(clock_topic, *topics)).select(
        bag,
        ts,
        seq,
        (F.col(topic) == clock_topic).cast("int").alias(CLOCK),
        *_one_column_per_topic(topic, value, topics),
    )
    return latest_on_clock(rows, bag, ts, seq, list(topics.values()), layout, target_rows)


def dedup_last(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: str = "seq"
) -> DataFrame:
    """One row per key with the last non-null value of each column.

    A declarative aggregate, so duplicates are merged before the exchange.
    """
    return df.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns]
    )


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    bag: str = "bag_id",
    order: Sequence[str] = ("ts_ns", "seq"),
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Replace nulls by the latest earlier value of the recording."""
    outputs = {f"_at_{c}": last_value(c) for c in columns}
    filled = scan(df, [bag], order, layout, target_rows, **outputs)
    return _replace(filled, df.columns, {c: F.col(f"_at_{c}") for c in columns})


def _replace(df: DataFrame, names: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    return df.select(*[values[c].alias(c) if c in values else F.col(c) for c in names])


def align_exact_fill(
    expected: DataFrame,
    rows: DataFrame,
    columns: Sequence[str],
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    fill: str = "latest_then_next",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Rows on exactly the expected timestamps, gaps filled from before, then from after.

    Only rows whose time is an expected time contribute. ``fill='latest'`` leaves gaps
    before the first value empty; the default also fills them from the next value.
    """
    if fill not in ("latest", "latest_then_next"):
        raise ValueError(f"unknown fill {fill}")
    unique = dedup_last(rows, [bag, ts], columns, seq)
    joined = expected.join(unique, [bag, ts], "left")
    order = [ts] + ([seq] if seq in expected.columns else [])
    outputs = {f"_last_{c}": last_value(c) for c in columns}
    if fill == "latest_then_next":
        outputs |= {f"_next_{c}": next_value(c) for c in columns}
    if layout is None:
        layout = measure(expected, [bag], order, target_rows)
    filled = scan(joined, [bag], order, layout, **outputs)
    values = {
        c: F.coalesce(*[F.col(n) for n in (f"_last_{c}", f"_next_{c}") if n in outputs])
        for c in columns
    }
    return _replace(filled, joined.columns, values)


def frame_lookup(
    rows: DataFrame,
    samples: DataFrame,
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    sample: str = "sample",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """The sample shown at each row's time: at or before it, clamped to the first one."""
    pointed = asof_pointer(
        rows, samples, F.col(sample).isNotNull(), bag=bag, ts=ts, seq=seq, clamp=True,
        layout=layout, target_rows=target_rows,
    )
    return fetch(pointed, samples, [sample], bag=bag, ts=ts, seq=seq)


POINTER = "_pointer"


def asof_pointer(
    clock: DataFrame,
    samples: DataFrame,
    present: Column,
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    seq: str = "seq",
    clamp: bool = False,
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """For each clock row, where the latest sample is: its (ts, seq), as column ``_pointer``.

    Only keys are sorted and carried, never the payload; ``present`` says which samples count.
    With ``clamp`` rows before the first sample point to the first. Rows are counted before
    ``present`` is asked, so counting reads keys only (an upper bound is enough).
    """
    ticks = clock.withColumn(CLOCK, F.lit(1))
    if seq not in clock.columns:
        ticks = ticks.withColumn(seq, F.lit(0).cast("bigint"))
    if layout is None:
        keys = ticks.select(bag, ts, CLOCK, seq).unionByName(samples.select(bag, ts, F.lit(0).alias(CLOCK), seq))
        layout = measure(keys, [bag], [ts, CLOCK, seq], target_rows)
    notes = samples.where(present).select(bag, ts, seq, F.lit(0).alias(CLOCK), F.struct(ts, seq).alias(POINTER))
    rows = ticks.unionByName(notes, allowMissingColumns=True)
    outputs = {"_before": last_value(POINTER)} | ({"_after": next_value(POINTER)} if clamp else {})
    found = scan(rows, [bag], [ts, CLOCK, seq], layout, **outputs).where(F.col(CLOCK) == 1)
    return found.select(*clock.columns, F.coalesce(*outputs).alias(POINTER))


def fetch(
    pointed: DataFrame,
    samples: DataFrame,
    columns: Sequence[str],
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    seq: str = "seq",
) -> DataFrame:
    """The payload columns of the samples pointed to: one join on (recording, time, sequence).

    Of samples that agree in all three one is taken.
    """
    named = samples.select(
        F.col(bag).alias("_p_bag"), F.col(ts).alias("_p_ts"), F.col(seq).alias("_p_seq"), *columns
    ).dropDuplicates(["_p_bag", "_p_ts", "_p_seq"])
    kept = [c for c in pointed.columns if c != POINTER and c not in columns]
    ready = pointed.select(*kept, F.col(POINTER)[ts].alias("_ts"), F.col(POINTER)[seq].alias("_seq"))
    same = (F.col(bag) == F.col("_p_bag")) & (F.col("_ts") == F.col("_p_ts")) & (F.col("_seq") == F.col("_p_seq"))
    return ready.join(named, same, "left").select(*kept, *columns)


def camera_zip(
    frames: DataFrame,
    cameras: Mapping[str, str],
    *,
    bag: str = "bag_id",
    camera: str = "camera",
    order: Sequence[str] = ("ts_ns", "seq"),
    value: str = "value",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Cameras joined by position: the n-th frame of each.

    ``cameras`` maps a camera to its output column. Recordings whose cameras differ in length
    are not zipped: ``unequal_cameras`` lists them. Counting and numbering read the keys only; each
    payload is then given its position by one join on its key, and brought together with those of the
    other cameras by one aggregate on (recording, position). Of frames of a camera that agree in all
    of ``order`` one is taken.
    """
    chosen = frames.where(F.col(camera).isin(*cameras))
    keys = chosen.select(bag, camera, *order).distinct()
    counted = materialize(keys.groupBy(bag, camera).agg(F.count(F.lit(1)).alias("_rows")))
    lengths = counted.groupBy(bag).agg(F.count(F.lit(1)).alias("_cameras"), F.min("_rows").alias("_least"), F.max("_rows").alias("_most"))
    even = lengths.where((F.col("_cameras") == len(cameras)) & (F.col("_least") == F.col("_most"))).select(bag)
    total = totals(counted, "_rows")
    if layout is None:
        layout = measure(keys, [bag, camera], order, target_rows, total)
    numbered = scan(side_join(keys, even, [bag], "left_semi", rows=total.n_keys), [bag, camera], order, layout, target_rows, _n=row_number())
    placed = side_join(chosen.select(bag, camera, *order, value), numbered, [bag, camera, *order], "inner", rows=total.n_rows)
    return placed.groupBy(bag, (F.col("_n") - 1).alias("frame_no")).agg(
        *[F.max(F.when(F.col(camera) == c, F.col(value))).alias(out) for c, out in cameras.items()]
    )


def unequal_cameras(
    frames: DataFrame, cameras: Sequence[str], *, bag: str = "bag_id", camera: str = "camera"
) -> DataFrame:
    """Recordings ``camera_zip`` rejects: (bag, shortest, longest)."""
    return stream_length_mismatch(frames, cameras, bag=bag, camera=camera)


def collapse_repeats(
    df: DataFrame,
    expected: DataFrame,
    *,
    bag: str = "bag_id",
    order: Sequence[str] = ("ts_ns", "seq"),
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Every k-th row of recordings that hold exactly k times the expected rows.

    ``expected`` has one row per recording: (bag, ``expected``). Recordings whose count is no
    exact multiple cannot be aligned: ``uneven_repeats`` lists them, with those that only one
    of the two tables has.
    """
    factors = (
        _repeat_counts(df, expected, bag)
        .where("fits")
        .select(bag, F.expr("n_rows DIV expected").alias("_k"))
    )
    if layout is None:
        layout = measure(df, [bag], order, target_rows)
    numbered = scan(df, [bag], order, layout, _rn=row_number())
    joined = side_join(numbered, factors, [bag], "inner", rows=layout.n_keys)
    return joined.where((F.col("_rn") - 1) % F.col("_k") == 0).drop("_rn", "_k")


def _repeat_counts(df: DataFrame, expected: DataFrame, bag: str) -> DataFrame:
    counts = df.groupBy(bag).agg(F.count(F.lit(1)).alias("n_rows"))
    fits = (F.col("expected") > 0) & (F.col("n_rows") % F.expr("nullif(expected, 0)") == 0)
    return counts.join(expected.select(bag, "expected"), bag, "full").withColumn(
        "fits", F.coalesce(fits, F.lit(False))
    )


def uneven_repeats(df: DataFrame, expected: DataFrame, *, bag: str = "bag_id") -> DataFrame:
    """Recordings ``collapse_repeats`` rejects: (bag, n_rows, expected), null where one is unknown."""
    return _repeat_counts(df, expected, bag).where("NOT fits").drop("fits")


def sort_clean_index(
    df: DataFrame, index: str, by: Sequence[str] = (), out: str = "ts_ns"
) -> DataFrame:
    """Parse the time index, drop rows without one, sort by it (a range-partitioned sort)."""
    dtype = df.schema[index].dataType
    if isinstance(dtype, T.StringType):
        parsed = ntz_micros(F.col(index).try_cast("timestamp_ntz")) * F.lit(1000).cast("bigint")
    else:
        parsed = F.col(index).try_cast("bigint")
    return df.withColumn(out, parsed).dropna(subset=[out]).orderBy(*by, out)
