import random

import numpy as np
import pytest

from robolog.operators.episodes import episode_stats
from robolog.operators.stats import dataset_stats, feature_sketches, histogram_stats, image_histograms, merge_moments


@pytest.mark.parametrize("channels", [1, 3, 4])
def test_histograms_agree_with_the_pixels(spark, channels):
    random.seed(4)
    frames = [(s, random.randbytes(random.randrange(0, 200))) for s in "abc" for _ in range(9)] + [("a", None), ("d", b""), ("e", b"\x07" * 40), (None, b"\x00\xff" * 12)]
    out = histogram_stats(image_histograms(spark.createDataFrame(frames, "stream string, data binary").repartition(5), ["stream"], channels=channels), ["stream"])
    found = {(r.stream, r.channel): r for r in out.collect()}
    want = {}
    for stream in "abcde", (None,):
        for s in stream:
            for c in range(channels):
                pixels = np.concatenate([np.frombuffer(d or b"", dtype=np.uint8)[c::channels] for n, d in frames if n == s])
                if len(pixels):
                    want[s, c] = pixels / 255
    assert found.keys() == want.keys()
    for key, x in want.items():
        r = found[key]
        assert (r["min"], r["max"], r["count"]) == (x.min(), x.max(), len(x))
        assert r["mean"] == pytest.approx(x.mean(), abs=1e-12) and r["std"] == pytest.approx(x.std(), abs=1e-12)
        assert r["q50"] == np.quantile(x, 0.5, method="inverted_cdf") and r["q99"] == np.quantile(x, 0.99, method="inverted_cdf")


def test_no_frames(spark):
    df = spark.createDataFrame([], "stream string, data binary")
    assert histogram_stats(image_histograms(df, ["stream"]), ["stream"]).count() == 0


def test_merged_moments_agree_with_all_rows(spark):
    random.seed(5)
    # Means far from zero: squares of the values would lose the spread.
    rows = [(e, [1e9 + random.random() + e, random.random()]) for e in range(6) for _ in range(1 + 5 * e)]
    df = spark.createDataFrame(rows, "episode_index bigint, v array<double>")
    found = {r.dim: r for r in merge_moments(episode_stats(df, {"v": "v"})).collect()}
    for dim in (0, 1):
        x = np.array([v[dim] for _, v in rows])
        r = found[dim]
        assert (r["min"], r["max"], r["count"], r["n_episodes"]) == (x.min(), x.max(), len(x), 6)
        assert r["mean"] == pytest.approx(x.mean(), rel=1e-14) and r["std"] == pytest.approx(x.std(), rel=1e-6)


def test_quantiles_of_merged_sketches(spark):
    random.seed(6)
    rows = [(e, [random.gauss(e, 1)]) for e in range(20) for _ in range(200)] + [(0, [float("nan")]), (1, [None])]
    df = spark.createDataFrame(rows, "episode_index bigint, v array<double>")
    stats = episode_stats(df.where("NOT coalesce(isnan(v[0]), true)"), {"v": "v"})
    (r,) = dataset_stats(stats, feature_sketches(df, {"v": "v"})).collect()
    x = np.sort([v[0] for _, v in rows if v[0] is not None and v[0] == v[0]])
    for name, q in {"q01": 0.01, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}.items():
        assert abs(np.searchsorted(x, r[name]) / len(x) - q) < 0.03
