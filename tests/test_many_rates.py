import itertools
import random

from robolog.operators.timeline import downsample_fps


def kept_frames(rate, target, frames):
    """Frame i is kept when its time reaches the next output instant; instants are added one by one."""
    rate = rate or 30.0
    step, due, out = 1.0 / min(target, rate), 0.0, []
    for i in range(frames):
        if i == 0 or i / rate + 1e-9 >= due:
            out.append(i)
            while due <= i / rate + 1e-9:
                due += step
    return out


def test_more_than_256_measured_rates(spark):
    random.seed(2)
    rates = {f"b{k}": random.uniform(1, 120) for k in range(300)} | {"none": None}
    df = spark.createDataFrame(
        [(b, i, 0, r) for b, r in rates.items() for i in range(40)], "bag_id string, ts_ns long, seq long, fps double")
    kept = downsample_fps(df, "fps", 10.0)
    assert kept.columns == [*df.columns, "frame_no"]
    rows = sorted((r.bag_id, r.frame_no) for r in kept.collect())
    found = {b: [i for _, i in g] for b, g in itertools.groupby(rows, key=lambda x: x[0])}
    assert found == {b: kept_frames(r, 10.0, 40) for b, r in rates.items()}


def test_rates_that_say_nothing_count_as_unknown(spark):
    rates = {"nan": float("nan"), "inf": float("inf"), "neg": -5.0, "zero": 0.0, "none": None, "low": 7.3, "same": 10.0}
    df = spark.createDataFrame([(b, i, 0, r) for b, r in rates.items() for i in range(40)], "bag_id string, ts_ns long, seq long, fps double")
    rows = sorted((r.bag_id, r.frame_no) for r in downsample_fps(df, "fps", 10.0).collect())
    found = {b: [i for _, i in g] for b, g in itertools.groupby(rows, key=lambda x: x[0])}
    assert found == {b: kept_frames(r if b in ("low", "same") else None, 10.0, 40) for b, r in rates.items()}


def test_rates_are_not_brought_to_the_driver(spark):
    from pyspark.sql.classic.dataframe import DataFrame

    df = spark.createDataFrame([(str(b), i, 0, 20.0 + b) for b in range(5) for i in range(9)], "bag_id string, ts_ns long, seq long, fps double")
    collect = DataFrame.collect

    def refuse(self):
        assert "fps" not in self.columns and "__rate" not in self.columns
        return collect(self)

    DataFrame.collect = refuse
    try:
        kept = downsample_fps(df, "fps", 10.0)
    finally:
        DataFrame.collect = collect
    assert kept.count() > 0
