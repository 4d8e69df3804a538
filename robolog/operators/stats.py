"""Statistics that merge: image histograms, moments of episodes, quantile sketches."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from robolog.operators.joins import side_join

#: Streams a task adds up before it sends their histograms on.
HELD_STREAMS = 256
QUANTILES = {"q01": 0.01, "q10": 0.10, "q50": 0.50, "q90": 0.90, "q99": 0.99}


def _add_frames(batches: Iterator[pa.RecordBatch], n_keys: int, channels: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Histogram rows of raw frames: byte i of a frame is of channel i modulo ``channels``."""
    held: dict[tuple, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        keys, where, counts = [], [], []
        for key, bins in held.items():
            at = np.flatnonzero(bins)
            keys += [key] * len(at)
            where.append(at)
            counts.append(bins[at])
        at = np.concatenate(where) if where else np.zeros(0, dtype=np.int64)
        columns = [pa.array([k[i] for k in keys], schema.field(i).type) for i in range(n_keys)]
        columns += [pa.array(at // 256, pa.int32()), pa.array(at % 256, pa.int32()), pa.array(np.concatenate(counts) if counts else at, pa.int64())]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)), strict=True))
        for key, frame in zip(keys, batch.column(n_keys), strict=True):
            if not frame.is_valid:
                continue
            pixels = np.frombuffer(frame.as_buffer(), dtype=np.uint8)
            bins = held.setdefault(key, np.zeros(256 * channels, dtype=np.int64))
            for c in range(channels):
                bins[256 * c: 256 * (c + 1)] += np.bincount(pixels[c::channels], minlength=256)
        if len(held) > HELD_STREAMS:
            yield rows()
    yield rows()


def image_histograms(frames: DataFrame, keys: Sequence[str], data: str = "data", channels: int = 3) -> DataFrame:
    """Pixels of each value per stream and channel: (*keys, channel, value, n), without values that do not occur.

    ``data`` is raw interleaved bytes, as of an uncompressed image. Nothing is decoded or exploded: tasks
    count bytes in numpy, and at most 256 rows a stream and channel leave each of them.
    """
    types = [frames.schema[k].dataType.simpleString() for k in keys]
    fields = [f"`{k}` {t}" for k, t in zip(keys, types, strict=True)]
    names = len(keys)

    def run(batches):
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([*(first.schema.field(i) for i in range(names)), ("channel", pa.int32()), ("value", pa.int32()), ("n", pa.int64())])

        def all_batches():
            yield first
            yield from batches

        yield from _add_frames(all_batches(), names, channels, schema)

    found = frames.select(*keys, F.col(data).cast("binary").alias("_data")).mapInArrow(run, ", ".join([*fields, "channel int", "value int", "n bigint"]))
    return found.groupBy(*keys, "channel", "value").agg(F.sum("n").alias("n"))


def histogram_stats(histograms: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float] = QUANTILES, scale: float = 255.0) -> DataFrame:
    """min, max, mean, population std, count and exact quantiles of pixel values, as shares of ``scale``.

    Counts and sums are whole numbers, so the result does not depend on how frames were dealt. A quantile is
    the least value that at least that share of the pixels does not exceed. Merging streams is adding up
    their histograms: give fewer keys.
    """
    whole = histograms.groupBy(*keys, "channel", "value").agg(F.sum("n").alias("n"))
    stream = Window.partitionBy(*keys, "channel")
    running = whole.select("*", F.sum("n").over(stream.orderBy("value")).alias("_upto"), F.sum("n").over(stream).alias("_all"))
    value, n = F.col("value").cast("bigint"), F.col("n")
    total, squares, count = F.sum(value * n), F.sum(value * value * n), F.sum(n)
    # Whole numbers until the last division, so equal pixels have no spread at all; good for 10^14 pixels a channel.
    whole_19 = [x.cast("decimal(19,0)") for x in (count, squares, total)]
    spread = whole_19[0] * whole_19[1] - whole_19[2] * whole_19[2]
    std = F.sqrt(spread.cast("double")) / count.cast("double")
    return running.groupBy(*keys, "channel").agg(
        (F.min("value") / scale).alias("min"), (F.max("value") / scale).alias("max"),
        (total.cast("double") / count.cast("double") / scale).alias("mean"), (std / scale).alias("std"), F.sum("n").alias("count"),
        *[(F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(q)), F.col("value"))) / scale).alias(name) for name, q in quantiles.items()],
    )


def merge_moments(stats: DataFrame, keys: Sequence[str] = ("feature", "dim")) -> DataFrame:
    """Statistics of all episodes from those of each: min, max, mean, population std and count per key.

    ``stats`` has these columns per episode and key. The common mean is found first and the squared
    differences are taken from it, so nothing cancels, however far the means lie from zero.
    """
    keys = list(keys)
    some = stats.where("count > 0")
    means = some.groupBy(*keys).agg((F.sum(F.col("count") * F.col("mean")) / F.sum("count")).alias("_mean"), F.count(F.lit(1)).alias("n_episodes"))
    joined = side_join(some, means, keys, "inner")
    gap = F.col("mean") - F.col("_mean")
    return joined.groupBy(*keys).agg(
        F.min("min").alias("min"), F.max("max").alias("max"), F.first("_mean").alias("mean"),
        F.sqrt(F.sum(F.col("count") * (F.col("std") * F.col("std") + gap * gap)) / F.sum("count")).alias("std"),
        F.sum("count").alias("count"), F.first("n_episodes").alias("n_episodes"),
    )


def _dimensions(rows: DataFrame, features: Mapping[str, str], episode: str) -> DataFrame:
    named = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(c).cast("array<double>").alias("vector")) for f, c in features.items()])
    long = rows.select(episode, F.inline(named)).select(episode, "feature", F.posexplode("vector").alias("dim", "value"))
    return long.withColumn("dim", F.col("dim").cast("bigint"))


def feature_sketches(rows: DataFrame, features: Mapping[str, str], episode: str = "episode_index", k: int = 200) -> DataFrame:
    """A KLL quantile sketch per episode, feature and dimension; at the default size ranks are good to about 1.7 percent."""
    long = _dimensions(rows, features, episode).where("value IS NOT NULL AND NOT isnan(value)")
    return long.groupBy(episode, "feature", "dim").agg(F.kll_sketch_agg_double("value", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str] = ("feature", "dim"), quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """Quantiles over all episodes from their sketches, which merge without the rows behind them."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_sketch"))
    at: Column = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(float(q)) for q in quantiles.values()]))
    return merged.withColumn("_q", at).select(*keys, *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(quantiles)])


def dataset_stats(stats: DataFrame, sketches: DataFrame | None = None, keys: Sequence[str] = ("feature", "dim")) -> DataFrame:
    """One row per feature and dimension over all episodes: merged moments, and quantiles where sketches are given."""
    moments = merge_moments(stats, keys)
    return moments if sketches is None else moments.join(sketch_quantiles(sketches, keys), list(keys), "left")
