"""Time steps, frame rates, regular grids and downsampling."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from robolog.contracts import DEFAULT_SOURCE_FPS, DEFAULT_TARGET_FPS, FPS_TOLERANCE, NS
from robolog.operators.align import asof_align
from robolog.operators.joins import side_join
from robolog.operators.layout import TARGET_ROWS, Layout, measure
from robolog.operators.scan import lag, row_number, running_sum, scan
from robolog.session import materialize

GRID_BLOCK = 10_000


def time_steps(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts_ns",
    seq: str = "seq",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Add ``step_ns``, the time since the row before; null on the first row."""
    stepped = scan(df, keys, [ts, seq], layout, target_rows, _before=lag(ts))
    return stepped.withColumn("step_ns", F.col(ts) - F.col("_before")).drop("_before")


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str,
    target_rows: int | None = None,
    layout: Layout | None = None,
    rows: str = "_rows",
) -> DataFrame:
    """Exact median of an integer column per key, and the number of rows (null values too).

    ``layout`` may be that of rows of which ``df`` has at most as many per key; nothing is
    counted anew then. Keys that fit one task use the built-in median in the aggregate that counts
    the rows. With an over-full key the values are first counted (value, n), which combines
    before the exchange, and the middle is read off running counts, which are split over
    tasks as any other scan; the two middle values are averaged as the built-in median does.
    """
    keys = list(keys)
    if layout is None:
        layout = measure(df.where(F.col(value).isNotNull()), keys, [value], target_rows)
    if layout.max_rows <= (target_rows or TARGET_ROWS):
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows), F.median(value).alias(out))
    # Read several times below; written once so that the steps are not computed again.
    counted = materialize(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    known = F.when(F.col(value).isNotNull(), F.col("_n"))
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias(rows), F.sum(known).alias("_total"))
    running = scan(
        counted.where(F.col(value).isNotNull()), keys, [value], target_rows=target_rows, _upto=running_sum("_n")
    )
    joined = side_join(running, totals.select(*keys, "_total"), keys, "inner", rows=layout.n_keys, null_safe=True)
    low = F.min(F.when(F.col("_upto") > F.expr("(_total - 1) DIV 2"), F.col(value)))
    high = F.min(F.when(F.col("_upto") > F.expr("_total DIV 2"), F.col(value)))
    middle = F.when(low == high, low.cast("double")).otherwise(0.5 * low.cast("double") + 0.5 * high.cast("double"))
    medians = joined.groupBy(*keys).agg(middle.alias(out))
    return side_join(totals.drop("_total"), medians, keys, "left", rows=layout.n_keys, null_safe=True)


def infer_fps(
    frames: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts_ns",
    seq: str = "seq",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Frame rate per stream from the median positive step, with a status per stream.

    The median is cut to whole nanoseconds and the rate is rounded half to even.
    """
    keys = list(keys)
    if layout is None:
        layout = measure(frames, keys, [ts, seq], target_rows)
    steps = time_steps(frames, keys, ts=ts, seq=seq, layout=layout, target_rows=target_rows)
    positive = steps.withColumn("step_ns", F.when(F.col("step_ns") > 0, F.col("step_ns")))
    medians = exact_median(positive, keys, "step_ns", "_median", target_rows, layout, "n_times")
    whole = F.col("_median").cast("bigint")
    return medians.select(
        *keys,
        "n_times",
        whole.alias("median_step_ns"),
        F.rint(F.lit(float(NS)) / whole).cast("bigint").alias("fps"),
        F.when(F.col("n_times") < 2, "too few timestamps")
        .when(whole.isNull(), "no positive step")
        .otherwise("ok")
        .alias("status"),
    )


def fps_check(
    frames: DataFrame,
    keys: Sequence[str],
    target_fps: float,
    *,
    tolerance: float = FPS_TOLERANCE,
    ts: str = "ts_ns",
    seq: str = "seq",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Whether each stream already runs at the target rate, over all its steps."""
    keys = list(keys)
    if layout is None:
        layout = measure(frames, keys, [ts, seq], target_rows)
    steps = time_steps(frames, keys, ts=ts, seq=seq, layout=layout, target_rows=target_rows)
    medians = exact_median(steps, keys, "step_ns", "_median", target_rows, layout, "n_times")
    source = F.when(F.col("n_times") < 2, F.lit(0.0)).otherwise(
        F.try_divide(F.lit(float(NS)), F.col("_median"))
    )
    rate = F.col("source_fps")
    close = F.abs(rate - F.lit(float(target_fps))) / F.lit(float(target_fps)) <= F.lit(tolerance)
    return (
        medians.withColumn("source_fps", source)
        .select(
            *keys,
            "source_fps",
            (F.coalesce(close, F.lit(False)) & (F.col("n_times") >= 2)).alias("keeps_rate"),
        )
    )


def time_grid(
    df: DataFrame, fps: float, *, bag: str = "bag_id", ts: str = "ts_ns"
) -> DataFrame:
    """Regular times from the first (included) to the last (excluded) of each recording.

    A recording with a single instant has that one point. Long grids are made in blocks,
    spread over the cluster between the two explodes, so no row holds a whole grid.
    """
    step = int(NS / fps)
    bounds = df.groupBy(bag).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    points = F.expr(f"greatest((_hi - _lo + {step} - 1) DIV {step}, 1)")
    blocks = (
        bounds.where(F.col("_lo").isNotNull())
        .withColumn("_points", points)
        .withColumn("_block", F.explode(F.expr(f"sequence(0, (_points - 1) DIV {GRID_BLOCK})")))
        .repartition(F.col(bag), F.col("_block"))
    )
    inside = F.expr(
        f"sequence(_block * {GRID_BLOCK}, least((_block + 1) * {GRID_BLOCK}, _points) - 1)"
    )
    return blocks.select(bag, "_lo", F.explode(inside).alias("grid_no")).select(
        bag, "grid_no", (F.col("_lo") + F.col("grid_no") * F.lit(step).cast("bigint")).alias(ts)
    )


def grid_resample(
    messages: DataFrame,
    fps: float,
    topics: Mapping[str, str],
    *,
    bag: str = "bag_id",
    ts: str = "ts_ns",
    target_rows: int | None = None,
    **names: str,
) -> DataFrame:
    """Latest value of every topic on a regular grid over each recording."""
    grid = time_grid(messages, fps, bag=bag, ts=ts)
    return asof_align(grid, messages, topics, bag=bag, ts=ts, target_rows=target_rows, **names)


def relative_time(
    df: DataFrame, *, bag: str = "bag_id", ts: str = "ts_ns", out: str = "timestamp"
) -> DataFrame:
    """Seconds since the first row of the recording, as float32.

    Only the first time per recording is aggregated and joined back; rows do not move.
    """
    first = df.groupBy(bag).agg(F.min(ts).alias("_first"))
    joined = side_join(df, first, [bag], "left")
    return joined.withColumn(out, ((F.col(ts) - F.col("_first")) / float(NS)).cast("float")).drop("_first")


def output_instants(fps: float, until: float) -> list[tuple[float, int, float, int]]:
    """Instants 0, 1/fps, 2/fps ... as repeated float addition gives them, in runs.

    Adding the same double again and again moves by a constant amount while the sum stays
    between two powers of two (after one step, which settles rounding of halves). So the
    whole series up to ``until`` seconds is a few runs of (first instant, its number,
    distance, count), each exact.
    """
    step = 1.0 / fps
    runs: list[tuple[float, int, float, int]] = []
    at, number = 0.0, 0
    while at <= until:
        follow = at + step
        top = 2.0 ** math.frexp(at)[1] if at > 0 else 0.0
        runs.append((at, number, math.inf, 1))
        if follow >= top:
            at, number = follow, number + 1
            continue
        distance = (follow + step) - follow
        count = 0
        if follow + step < top:
            count = int((top - follow) / distance)
            while follow + count * distance >= top:
                count -= 1
        if count > 0:
            runs.append((follow, number + 1, distance, count + 1))
            last = follow + count * distance
            at, number = last + step, number + count + 2
        else:
            at, number = follow, number + 1
    return runs


# Frames tried on the driver when the rule is planned, a few megabytes of doubles.
PROBED_FRAMES = 400_000


def _plain_runs(runs: list[tuple[float, int, float, int]], source: float, step: float) -> int:
    """How many leading runs can be replaced by floor(seconds / step).

    Rounding moves the instants only slowly away from multiples of the step. The first
    frames are tried one by one, and the plain formula covers the runs that end before the
    first frame on which the two differ.
    """
    seconds = np.arange(PROBED_FRAMES) / source + 1e-9
    added = np.cumsum(np.full(int(seconds[-1] / step) + 2, step))
    instants = np.concatenate([[0.0], added])
    due = np.searchsorted(instants, seconds, side="right")
    differ = np.flatnonzero(due != np.floor(seconds / step) + 1)
    same_until = seconds[differ[0]] if len(differ) else seconds[-1]
    if not len(differ) and _last(runs) <= same_until:
        return len(runs)
    starts = [start for start, *_ in runs]
    return max(0, int(np.searchsorted(starts, same_until, side="right")) - 1)


def _last(runs: list[tuple[float, int, float, int]]) -> float:
    start, _, distance, count = runs[-1]
    return start if count == 1 else start + distance * (count - 1)


def _due(seconds: str, runs: list[tuple[float, int, float, int]], plain: int, step: float) -> str:
    """SQL for how many output instants are at or before ``seconds``."""
    branches = []
    for start, number, distance, count in reversed(runs[plain:]):
        if count == 1:
            here = f"{number + 1}L"
        else:
            here = f"least(floor(({seconds} - {start!r}D) / {distance!r}D), {count - 1}L) + {number + 1}L"
        branches.append(f"WHEN {seconds} >= {start!r}D THEN {here}")
    first = f"floor({seconds} / {step!r}D) + 1L" if plain else "0L"
    return f"CASE {' '.join(branches)} ELSE {first} END" if branches else f"({first})"


def keep_frames(
    df: DataFrame, frame_no: str, source_fps: float, target_fps: float, max_seconds: float
) -> DataFrame:
    """Rows whose frame is kept when a stream is thinned to the target rate.

    Frame i is kept when its time i / source reaches the next output instant. The rule is
    a function of the frame number alone, so it needs no state and no order.
    """
    return df.where(_keep_rule(frame_no, source_fps, target_fps, max_seconds))


def _keep_rule(frame_no: str, source_fps: float, target_fps: float, max_seconds: float) -> Column:
    if target_fps <= 0:
        raise ValueError(f"target fps must be positive, got {target_fps}")
    source = float(source_fps if source_fps and source_fps > 0 else DEFAULT_SOURCE_FPS)
    output = min(float(target_fps), source)
    runs = output_instants(output, max_seconds)
    plain = _plain_runs(runs, source, 1.0 / output)

    def due(frame: str) -> str:
        return _due(f"(CAST({frame} AS DOUBLE) / {source!r}D + 1e-9D)", runs, plain, 1.0 / output)

    due_here = F.expr(f"`{frame_no}` = 0 OR {due(f'`{frame_no}`')} > {due(f'(`{frame_no}` - 1)')}")
    planned = F.col(frame_no) <= int(max_seconds * source) - 1
    problem = F.raise_error(F.lit("stream is longer than max_seconds")).cast("boolean")
    return F.when(planned, due_here).otherwise(problem)


_RATES_SCHEMA = (
    "__rate double, __source double, __step double, __plain boolean, __last bigint, "
    "__runs array<struct<start: double, number: bigint, distance: double, count: bigint>>"
)


def _planned(rate: float, target_fps: float, max_rows: int) -> tuple:
    """What :func:`_keep_rule` plans for a rate, as a row of the table of rates."""
    source = rate if rate > 0 else float(DEFAULT_SOURCE_FPS)
    output, longest = min(float(target_fps), source), (max_rows + 1) / rate
    runs = output_instants(output, longest)
    plain = _plain_runs(runs, source, 1.0 / output)
    rest = [(float(a), int(b), float(c), int(d)) for a, b, c, d in runs[plain:]]
    return rate, source, 1.0 / output, bool(plain), int(longest * source) - 1, rest


def _known_rate(column: str) -> Column:
    """A rate that says something: neither null, zero or less, infinite, nor no number."""
    rate = F.col(column).cast("double")
    return F.coalesce((rate > 0) & (rate < F.lit(float("inf"))), F.lit(False))


def _rate_plans(frames: DataFrame, column: str, target_fps: float, max_rows: int) -> DataFrame:
    """A row for each distinct rate with the runs of its output instants, planned where the rates are, not on the driver."""
    rates = frames.where(_known_rate(column)).select(F.col(column).cast("double").alias("__rate")).distinct()

    def plan(batches):
        for batch in batches:
            rows = [_planned(rate, target_fps, max_rows) for rate in batch.column(0).to_pylist()]
            if rows:
                names = ["__rate", "__source", "__step", "__plain", "__last", "__runs"]
                run = pa.struct([("start", pa.float64()), ("number", pa.int64()), ("distance", pa.float64()), ("count", pa.int64())])
                kinds = [pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.list_(run)]
                columns = [list(c) for c in zip(*rows, strict=True)]
                columns[5] = [[dict(zip(("start", "number", "distance", "count"), r, strict=True)) for r in runs] for runs in columns[5]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rates.mapInArrow(plan, _RATES_SCHEMA)


def _keep_by_rate(numbered: DataFrame, frames: DataFrame, column: str, target_fps: float, max_rows: int, unknown: Column) -> DataFrame:
    """Rows kept by the rule of their own rate, which is joined to them; ``unknown`` decides where there is none."""
    if target_fps <= 0:
        raise ValueError(f"target fps must be positive, got {target_fps}")
    table = _rate_plans(frames, column, target_fps, max_rows)

    def due(frame: str) -> str:
        seconds = f"(CAST({frame} AS DOUBLE) / __source + 1e-9D)"
        run = f"element_at(filter(__runs, r -> {seconds} >= r.start), -1)"
        here = f"transform(array({run}), r -> IF(r.count = 1, 0L, least(floor(({seconds} - r.start) / r.distance), r.count - 1)) + r.number + 1L)[0]"
        reached = f"exists(__runs, r -> {seconds} >= r.start)"
        return f"CASE WHEN {reached} THEN {here} WHEN __plain THEN floor({seconds} / __step) + 1L ELSE 0L END"

    rule = F.expr(f"frame_no = 0 OR {due('frame_no')} > {due('(frame_no - 1)')}")
    problem = F.raise_error(F.lit("stream is longer than max_seconds")).cast("boolean")
    kept = F.when(F.col("frame_no") <= F.col("__last"), rule).otherwise(problem)
    rated = numbered.withColumn("__rate", F.when(_known_rate(column), F.col(column).cast("double")))
    joined = side_join(rated, table, ["__rate"], "left")
    return joined.where(F.when(F.col("__rate").isNotNull(), kept).otherwise(unknown)).select(*numbered.columns)


def downsample_fps(
    frames: DataFrame,
    source_fps: float | str,
    target_fps: float = DEFAULT_TARGET_FPS,
    *,
    keys: Sequence[str] = ("bag_id",),
    order: Sequence[str] = ("ts_ns", "seq"),
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Number the frames of each stream from 0 and keep those the target rate asks for.

    ``source_fps`` is one rate, or the column that holds each recording's own; there a rate that is
    null, not positive, infinite or no number counts as unknown. The rule is planned for each rate and
    for the longest stream the layout has counted. Rates of a column are planned in parallel and
    joined to the frames behind a check of their size, so every recording may have its own.
    """
    keys = list(keys)
    if layout is None:
        layout = measure(frames, keys, order, target_rows)
    numbered = scan(frames, keys, order, layout, _rn=row_number())
    numbered = numbered.withColumn("frame_no", F.col("_rn") - 1).drop("_rn")
    if isinstance(source_fps, str):
        unknown = _keep_rule("frame_no", DEFAULT_SOURCE_FPS, target_fps, (layout.max_rows + 1) / DEFAULT_SOURCE_FPS)
        return _keep_by_rate(numbered, frames, source_fps, target_fps, layout.max_rows, unknown)
    source = source_fps if source_fps and source_fps > 0 else DEFAULT_SOURCE_FPS
    longest = (layout.max_rows + 1) / source
    return keep_frames(numbered, "frame_no", source_fps, target_fps, longest)
