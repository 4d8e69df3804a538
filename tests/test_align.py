import pytest
from pyspark.sql import functions as F

from robolog.operators import align, timeline
from robolog.plans.align import align_bags, align_images, aligned_joints
from robolog.contracts import ARM_JOINTS

LOG = "bag_id string, entity_path string, ts_ns bigint, seq bigint, value string"
CLOCK = "bag_id string, ts_ns bigint, seq bigint"


def asof(spark, frames, messages, **options):
    clock = spark.createDataFrame([("a", t, i) for i, t in enumerate(frames)], CLOCK)
    log = spark.createDataFrame([("a", "/x", *m) for m in messages], LOG)
    out = align.asof_align(clock, log, {"/x": "x"}, **options)
    return [r.x for r in out.orderBy("seq").collect()]


@pytest.mark.parametrize("target", [None, 1])
@pytest.mark.parametrize(
    "frames,messages,expected",
    [
        ([0], [(5, 1, "a")], [None]),
        ([5], [(5, 1, "a")], ["a"]),
        ([5], [(5, 2, "b"), (5, 1, "a")], ["b"]),
        ([4], [(1, 1, "a"), (3, 2, None)], ["a"]),
        ([1, 1, 2], [(1, 1, "a"), (2, 2, "b")], ["a", "a", "b"]),
        ([3, 9], [], [None, None]),
    ],
)
def test_latest_at(spark, frames, messages, expected, target):
    assert asof(spark, frames, messages, target_rows=target) == expected


def test_nanoseconds_beyond_double_precision(spark):
    base = 1_700_000_000_000_000_000
    assert asof(spark, [base + 1, base + 2], [(base + 2, 1, "late")]) == [None, "late"]
    assert asof(spark, [base + 1, base + 2], [(base + 2, 1, "late")], target_rows=1) == [None, "late"]


def test_many_topics_one_exchange(spark):
    log = spark.range(1000).select(
        (F.col("id") % 3).alias("bag_id"),
        F.concat(F.lit("/t"), (F.col("id") % 5).cast("string")).alias("entity_path"),
        F.col("id").alias("ts_ns"),
        F.col("id").alias("seq"),
        F.col("id").alias("value"),
    )
    out = align.asof_align_log(log, "/t0", {f"/t{i}": f"t{i}" for i in range(1, 5)})
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Window ") == 1 and text.count("Range") == 1
    row = out.where("ts_ns = 500").first()
    assert [row[f"t{i}"] for i in range(1, 5)] == [491, 497, 488, 494]


def test_clock_rows_are_kept(spark):
    """Repeated and tied clock rows all come out, whatever the split."""
    clock = spark.range(500).select(
        F.lit("a").alias("bag_id"), F.lit(7).cast("bigint").alias("ts_ns"), F.col("id").alias("seq")
    )
    log = spark.createDataFrame([("a", "/x", 6, 1, "m"), ("a", "/x", 7, 2, "n")], LOG)
    for target in (None, 20):
        out = align.asof_align(clock, log, {"/x": "x"}, target_rows=target)
        assert out.count() == 500
        assert [r.x for r in out.select("x").distinct().collect()] == ["n"]


def test_dedup_keeps_last_value_per_column(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 10, 20), ("a", 1, 2, None, 21), ("a", 2, 3, None, None)],
        "bag_id string, ts_ns bigint, seq bigint, x int, y int",
    )
    out = align.dedup_last(df, ["bag_id", "ts_ns"], ["x", "y"]).orderBy("ts_ns").collect()
    assert [(r.x, r.y) for r in out] == [(10, 21), (None, None)]


@pytest.mark.parametrize("target", [None, 1])
def test_exact_alignment_fills(spark, target):
    expected = spark.createDataFrame([("a", t) for t in (1, 2, 3, 4)], "bag_id string, ts_ns bigint")
    rows = spark.createDataFrame(
        [("a", 2, 1, "x"), ("a", 2, 2, "y"), ("a", 9, 3, "off"), ("a", 4, 4, None)],
        "bag_id string, ts_ns bigint, seq bigint, v string",
    )
    def values(fill):
        out = align.align_exact_fill(expected, rows, ["v"], fill=fill, target_rows=target)
        return [r.v for r in out.orderBy("ts_ns").collect()]
    assert values("latest_then_next") == ["y", "y", "y", "y"]
    assert values("latest") == [None, "y", "y", "y"]


def test_lookup_clamps_to_first(spark):
    clock = spark.createDataFrame([("a", 1, 0), ("a", 6, 1), ("b", 3, 2)], CLOCK)
    samples = spark.createDataFrame(
        [("a", 5, 1, "p"), ("a", 6, 2, None), ("a", 8, 3, "q")],
        "bag_id string, ts_ns bigint, seq bigint, sample string",
    )
    out = align.frame_lookup(clock, samples).orderBy("seq").collect()
    assert [r.sample for r in out] == ["p", "p", None]


def test_collapse_repeats_only_exact_multiples(spark):
    df = spark.createDataFrame(
        [("a", t, i) for i, t in enumerate([1, 1, 2, 2, 3, 3])] + [("b", t, t) for t in range(5)],
        CLOCK,
    )
    expected = spark.createDataFrame([("a", 3), ("b", 2)], "bag_id string, expected bigint")
    for target in (None, 2):
        out = align.collapse_repeats(df, expected, target_rows=target).orderBy("seq").collect()
        assert [(r.bag_id, r.ts_ns, r.seq) for r in out] == [("a", 1, 0), ("a", 2, 2), ("a", 3, 4)]


def test_camera_zip_needs_streams_of_one_length(spark):
    even = [("a", "l", 1, 0, 10), ("a", "l", 2, 1, None), ("a", "r", 5, 0, 20), ("a", "r", 6, 1, 21)]
    longer = [("b", c, i, i, i) for c, n in (("l", 3), ("r", 2)) for i in range(n)]
    frames = spark.createDataFrame(even + longer, "bag_id string, camera string, ts_ns bigint, seq bigint, value int")
    cameras = {"l": "left", "r": "right"}
    out = align.camera_zip(frames, cameras).orderBy("bag_id", "frame_no").collect()
    assert [(r.bag_id, r.frame_no, r.left, r.right) for r in out] == [("a", 0, 10, 20), ("a", 1, None, 21)]
    assert [tuple(r) for r in align.unequal_cameras(frames, list(cameras)).collect()] == [("b", 2, 3)]


def test_sort_clean_index(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01",), ("x",), (None,), ("2024-01-01 00:00:00.5",)], "t string")
    out = align.sort_clean_index(df, "t").collect()
    assert [r.ts_ns for r in out] == [1704067200500000000, 1704067201000000000]


# --- clocks ---------------------------------------------------------------------------


def stream(spark, times):
    return spark.createDataFrame([("a", t, i) for i, t in enumerate(times)], CLOCK)


@pytest.mark.parametrize("target", [None, 1])
@pytest.mark.parametrize(
    "times,fps,status",
    [
        ([1], None, "too few timestamps"),
        ([4, 4, 4], None, "no positive step"),
        ([0, 0, 33898305, 67796610], 30, "ok"),
        ([0, 400000000, 800000000], 2, "ok"),
        ([0, 100000000, 100000000, 200000000], 10, "ok"),
    ],
)
def test_infer_fps(spark, times, fps, status, target):
    row = timeline.infer_fps(stream(spark, times), ["bag_id"], target_rows=target).first()
    assert (row.fps, row.status) == (fps, status)


def test_fps_check(spark):
    ok = lambda times, target: timeline.fps_check(stream(spark, times), ["bag_id"], target).first()
    second = 1_000_000_000
    assert ok([0, second // 10, second // 5], 10).keeps_rate
    assert not ok([0, second // 10, second // 5], 12).keeps_rate
    assert not ok([1], 10).keeps_rate and ok([1], 10).source_fps == 0.0
    assert not ok([1, 1, 1], 10).keeps_rate  # zero step
    # All steps count here, so two repeated times pull the median to zero.
    assert not ok([0, 0, 0, second // 10], 10).keeps_rate


@pytest.mark.parametrize("values", [[3], [1, 2], [5, 5, 1, 9], [7, 1, 1, 1, 8, 2]])
def test_exact_median_both_ways(spark, values):
    import statistics

    df = spark.createDataFrame([("a", v) for v in values], "k string, v bigint")
    for target in (None, 1):
        assert timeline.exact_median(df, ["k"], "v", "m", target).first().m == statistics.median(values)


def test_time_grid(spark, monkeypatch):
    monkeypatch.setattr(timeline, "GRID_BLOCK", 3)
    df = spark.createDataFrame([("a", 0, 0), ("a", 1_000_000_000, 1), ("b", 5, 2)], CLOCK)
    out = timeline.time_grid(df, 10).orderBy("bag_id", "grid_no").collect()
    assert [(r.bag_id, r.ts_ns) for r in out] == [("a", i * 100_000_000) for i in range(10)] + [("b", 5)]


def test_relative_time_is_float32(spark):
    df = stream(spark, [10, 1_500_000_010])
    out = timeline.relative_time(df)
    assert out.schema["timestamp"].dataType.simpleString() == "float"
    assert [r.timestamp for r in out.orderBy("ts_ns").collect()] == [0.0, 1.5]


# --- whole recordings -------------------------------------------------------------------

VALUES = "bag_id string, entity_path string, ts_ns bigint, seq bigint, values array<double>"


def test_align_bags_pads_and_rejects(spark):
    clock = spark.createDataFrame([("a", 1, 0), ("a", 5, 1), ("b", 5, 2)], CLOCK)
    log = spark.createDataFrame(
        [("a", "/g", 4, 1, [1.0, 2.0, 3.0, 4.0, 5.0]), ("a", "/e", 0, 2, [1.0] * 8), ("b", "/e", 1, 3, [2.0])],
        VALUES,
    )
    topics, targets = {"/g": "g", "/e": "e"}, {"/g": 6, "/e": 7}
    for stage in (False, True):
        out = align_bags(clock, log, topics, targets, stage=stage)
        frames = out.frames.orderBy("seq").collect()
        assert [r.g for r in frames] == [[0.0] * 6, [1, 2, 3, 4, 5, 0]]
        assert [len(r.e) for r in frames] == [8, 8]  # wider than the target survives
        status = {r.bag_id: (r.ok, r.empty_topics, r.n_frames) for r in out.status.collect()}
        assert status == {"a": (True, [], 2), "b": (False, ["/g"], 1)}
    dropped = align_bags(clock, log, topics, targets, missing="drop").frames.collect()
    assert [r.seq for r in dropped] == [1]


def test_aligned_joints_need_all_values(spark):
    clock = spark.createDataFrame([("a", 5, 0)], CLOCK)
    axes = {j: (0.0, 0.0, 1.0) for j in ARM_JOINTS}
    schema = "bag_id string, ts_ns bigint, seq bigint, values array<double>"
    good = spark.createDataFrame([("a", 1, 1, [float(i) for i in range(16)])], schema)
    out = aligned_joints(clock, good, axes).orderBy("joint_no").collect()
    assert [(r.joint, r.angle) for r in out] == list(zip(ARM_JOINTS, map(float, range(14))))
    short = spark.createDataFrame([("a", 1, 1, [1.0] * 13)], schema)
    with pytest.raises(Exception, match="fewer than 14"):
        aligned_joints(clock, short, axes).collect()
    with pytest.raises(ValueError):
        aligned_joints(clock, good, {})


def test_align_images_carries_and_starts_empty(spark):
    clock = spark.createDataFrame([("a", t, t) for t in (1, 4, 6)], CLOCK)
    shots = spark.createDataFrame(
        [("a", 3, 1, "cdr", b"\x89PNG\r\n\x1a\n1"), ("a", 5, 2, None, b"")],
        "bag_id string, ts_ns bigint, seq bigint, encoding string, blob binary",
    )
    out = align_images(clock, shots).orderBy("seq").collect()
    assert [bytes(r.blob) for r in out] == [b"", b"\x89PNG\r\n\x1a\n1", b"\x89PNG\r\n\x1a\n1"]
    assert {r.media_type for r in out} == {"image/png"}


def test_zip_counts_and_orders_without_payload(spark, tmp_path, monkeypatch):
    from robolog.operators import scan as ordered

    path = str(tmp_path / "frames")
    rows = [("a", c, i, i, bytes([i]) * 50) for c in ("l", "r") for i in range(5)] + [("b", "l", 0, 0, b"x")]
    spark.createDataFrame(rows, "bag_id string, camera string, ts_ns bigint, seq bigint, value binary").write.parquet(path)
    seen = []
    plain = ordered.scan
    monkeypatch.setattr(align, "scan", lambda df, *a, **k: seen.append(df.columns) or plain(df, *a, **k))
    out = align.camera_zip(spark.read.parquet(path), {"l": "left", "r": "right"})
    assert seen == [["bag_id", "camera", "ts_ns", "seq"]]
    assert sorted((r.bag_id, r.frame_no, bytes(r.left), bytes(r.right)) for r in out.collect()) == [("a", i, bytes([i]) * 50, bytes([i]) * 50) for i in range(5)]
