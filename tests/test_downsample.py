import pytest
from pyspark.sql import functions as F

from robolog.operators.timeline import downsample_fps, keep_frames, output_instants


def loop(frames, source, target):
    """The stateful rule, frame by frame."""
    step, due, kept = 1.0 / min(source, target), 0.0, []
    for i in range(frames):
        if i / source + 1e-9 >= due:
            kept.append(i)
            due += step
    return kept


RATES = [(30.0, 10.0), (29.97, 10.0), (30.0, 30.0), (15.0, 30.0), (60.0, 24.0), (30.0, 7.0), (25.0, 12.5), (59.94, 29.97)]


@pytest.mark.parametrize("source,target", RATES)
def test_matches_the_loop(spark, source, target):
    frames = 400_000
    rows = spark.range(frames).withColumnRenamed("id", "n")
    kept = keep_frames(rows, "n", source, target, 1e6)
    expected = loop(frames, source, target)
    total = kept.agg(
        F.count("*").alias("n"), F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q")
    ).first()
    assert (total.n, total.s, total.q) == (
        len(expected), sum(expected), sum(i * i for i in expected)
    )


def test_matches_the_loop_far_out(spark):
    """Long after rounding has moved the instants away from multiples of the step."""
    frames, source, target = 3_000_000, 30.0, 10.0
    expected = loop(frames, source, target)
    assert expected != list(range(0, frames, 3))
    kept = keep_frames(spark.range(frames).withColumnRenamed("id", "n"), "n", source, target, 1e6)
    total = kept.agg(F.count("*").alias("n"), F.sum("n").alias("s")).first()
    assert (total.n, total.s) == (len(expected), sum(expected))


@pytest.mark.parametrize("fps", [10.0, 30.0, 3.0, 29.97, 8.0, 12.5, 7.3])
def test_instants_are_repeated_additions(fps):
    runs = output_instants(fps, 2000.0)
    instants = [s + i * (d if c > 1 else 0.0) for s, _, d, c in runs for i in range(c)]
    numbers = [n + i for _, n, _, c in runs for i in range(c)]
    at, step = 0.0, 1.0 / fps
    for number, instant in zip(numbers, instants):
        assert instant == at
        at += step
    assert numbers == list(range(len(numbers)))
    assert len(numbers) > 2000 * fps - 2


def test_documented_cases(spark):
    frames = spark.range(30).select(
        F.lit("a").alias("bag_id"), F.col("id").alias("ts_ns"), F.col("id").alias("seq")
    )
    kept = [r.frame_no for r in downsample_fps(frames, 30.0, 10.0).orderBy("frame_no").collect()]
    assert kept == list(range(0, 30, 3))
    assert downsample_fps(frames, 15.0, 30.0).count() == 30
    assert downsample_fps(frames, 0.0, 10.0).count() == 10
    with pytest.raises(ValueError):
        downsample_fps(frames, 30.0, 0.0)


def test_longer_than_planned_fails(spark):
    rows = spark.range(100).withColumnRenamed("id", "n")
    with pytest.raises(Exception, match="longer than max_seconds"):
        keep_frames(rows, "n", 30.0, 10.0, 1.0).count()
