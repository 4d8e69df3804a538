"""The whole-recording job, its faults, and the plans behind it."""

import os

import pytest
from pyspark.sql import functions as F

from robolog.operators import align, images, joints, select, timeline
from robolog.operators import joins
from robolog.operators.scan import last_value, row_number, scan
from robolog.plans.align import align_images
from robolog.plans.dataset import run_full, run_tables
from robolog.session import discard_staged, scratch_root, write_once
from robolog.sinks.publish import read_dataset
from robolog.sources.catalog import CAMERA_FILES
from robolog.sources.log import read_messages, timeline_columns
from robolog.contracts import FRAMES, MESSAGES

POSE, JOINTS, WORDS = "/info/eef_left", "/joint_states/position", "/language_instruction"
TOPICS, WIDTHS = {JOINTS: "position", POSE: "pose"}, {POSE: 7}


def tables(spark, fault=None):
    """Two recordings; the second has the fault."""
    anchors = [("a", 1000), ("b", None if fault == "anchor" else 1000)]
    frames = [(bag, camera, i, i * 100, 1, 1_000_000) for bag in "ab" for camera in ("left_eye", "right_eye") for i in range(4)]
    if fault == "clock":
        frames = [f for f in frames if f[:2] != ("b", "left_eye")]
    if fault == "cameras":
        frames = [f for f in frames if f[:3] != ("b", "right_eye", 3)]
    messages = []
    for bag in "ab":
        messages += [
            (bag, POSE, "InstancePoses3D:translations", 1000, 1, [0.1, 0.2, 0.3], None),
            (bag, POSE, "InstancePoses3D:quaternions", 1000, 2, [0.4, 0.5, 0.6, 0.7] + [0.8] * (fault == "width" and bag == "b"), None),
            (bag, JOINTS, "Scalars:scalars", 1000, 3, None if fault == "empty" and bag == "b" else [1.0, 2.0], None),
            (bag, WORDS, None, 1000, 4, None, "pick up"),
            (bag, WORDS, None, 200_000, 5, None, "put down"),
        ]
    if fault == "unheard":
        messages = [m for m in messages if m[0] == "a"] + [("c", JOINTS, "Scalars:scalars", 1, 1, [1.0], None)]
    return (
        spark.createDataFrame([("a",), ("b",)], "bag_id string"),
        spark.createDataFrame(anchors, "bag_id string, first_frame_epoch_ns bigint"),
        spark.createDataFrame(frames, "bag_id string, camera string, frame_no bigint, pts bigint, tb_num int, tb_den int"),
        spark.createDataFrame(messages, "bag_id string, entity_path string, component string, ts_ns bigint, seq bigint, `values` array<double>, text string"),
    )


def test_pose_pairs_and_text_reach_the_dataset(spark, tmp_path):
    path = str(tmp_path / "out")
    run_tables(*tables(spark), path, topics=TOPICS, widths=WIDTHS, action_dim=2, strict=True)
    rows = read_dataset(spark, path).orderBy("index").collect()
    assert len(rows) == 8
    assert all([round(x, 6) for x in r.observation_state] == [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7] for r in rows)
    assert all(list(r.action) == [1.0, 2.0] for r in rows)
    assert [r.task for r in rows[:4]] == ["pick up", "pick up", "put down", "put down"]
    info = read_dataset(spark, path, "info").first()
    assert (info.total_episodes, info.total_frames, info.total_tasks, info.fps) == (2, 8, 2, 10_000)
    shapes = {r.name: list(r["shape"]) for r in read_dataset(spark, path, "features").collect()}
    assert shapes["action"] == [2] and shapes["observation_state"] == [7]
    files = read_dataset(spark, path, "episode_files").collect()
    assert len(files) == 2 and all(os.path.exists(f"{path}/{f.path}") for f in files) and sum(f.n_rows for f in files) == 8


@pytest.mark.parametrize("fault, reason", [
    ("anchor", "no clock anchor"), ("clock", "no left_eye frames"), ("cameras", "cameras differ in length"),
    ("empty", f"no value: {JOINTS}"), ("width", f"vector of another width: {POSE}"), ("unheard", f"no value: {JOINTS}"),
])
def test_every_fault_is_listed_and_strict_fails(spark, tmp_path, fault, reason):
    given = tables(spark, fault)
    with pytest.raises(RuntimeError, match="rejected"):
        run_tables(*given, str(tmp_path / "strict"), topics=TOPICS, widths=WIDTHS, action_dim=2, strict=True)
    assert not os.path.exists(tmp_path / "strict")
    path = str(tmp_path / "out")
    run_tables(*given, path, topics=TOPICS, widths=WIDTHS, action_dim=2)
    status = {r.bag_id: list(r.reasons) for r in read_dataset(spark, path, "status").collect()}
    assert status["a"] == [] and reason in status["b"]
    odd = {(r.bag_id, r.entity_path): r.observed for r in read_dataset(spark, path, "dim_mismatch").collect()}
    assert odd == {"width": {("b", POSE): 8}, "unheard": {("c", POSE): 0}}.get(fault, {})
    if fault == "unheard":
        assert status["c"] == ["no clock anchor", "no left_eye frames"]
    assert {r.segment_id for r in read_dataset(spark, path, "episodes").collect()} == {"a"}


@pytest.mark.parametrize("n_turns, reasons", [(4, [f"no value: {POSE}"]), (5, [f"no value: {POSE}", f"vector of another width: {POSE}"])])
def test_quaternions_alone_are_no_translations(spark, tmp_path, n_turns, reasons):
    bags, anchors, frames, messages = tables(spark)
    turned = F.when((F.col("bag_id") == "b") & F.col("component").endswith("quaternions"), F.array_repeat(F.lit(0.5), n_turns)).otherwise(F.col("values"))
    messages = messages.where("NOT (bag_id = 'b' AND component <=> 'InstancePoses3D:translations')").withColumn("values", turned)
    path = str(tmp_path / "out")
    run_tables(bags, anchors, frames, messages, path, topics=TOPICS, widths=WIDTHS, action_dim=2)
    status = {r.bag_id: list(r.reasons) for r in read_dataset(spark, path, "status").collect()}
    assert status == {"a": [], "b": reasons}
    assert {r.segment_id for r in read_dataset(spark, path, "episodes").collect()} == {"a"}


def test_unreadable_files_fail_the_read(spark, tmp_path):
    path = str(tmp_path / "messages")
    spark.createDataFrame([("a", "/x", None, 1, None, 1, [1.0], None, None, None, None)], MESSAGES).repartition(1).write.parquet(path)
    with open(path + "/part-broken.parquet", "wb") as file:
        file.write(b"PAR1 nothing that can be read")
    with pytest.raises(Exception):  # noqa: B017
        read_messages(spark, path).count()


def test_staged_folders_are_removed_after_a_run(spark, tmp_path):
    bag = "my_bag-24-05-01-10-00-00"
    os.makedirs(tmp_path / "bags" / bag / "video")
    (tmp_path / "bags" / bag / "video" / "cameras_first_frame.yaml").write_text("first_frame_time:\n  epoch_ns: 1000\n")
    frames = [(bag, "left_eye", i, i * 100, 1, 1_000_000, "h264", b"x") for i in range(3)]
    spark.createDataFrame(frames, FRAMES).write.parquet(str(tmp_path / "frames"))
    messages = [(bag, p, None, None, 1000, 1, [1.0], None, None, None, None) for p in (JOINTS, POSE)]
    spark.createDataFrame(messages, MESSAGES).write.parquet(str(tmp_path / "messages"))
    root = scratch_root(spark).removeprefix("file://")
    before = {d for d in os.listdir(root) if d.startswith("stage-")}
    run_full(spark, str(tmp_path / "bags"), str(tmp_path / "messages"), str(tmp_path / "frames"), str(tmp_path / "out"),
             topics=TOPICS, widths=WIDTHS, action_dim=1)
    # Messages have only a publish time, so they are placed by it.
    assert read_dataset(spark, str(tmp_path / "out")).count() == 3
    lacking = {r.name for r in read_dataset(spark, str(tmp_path / "out"), "missing_inputs").collect()}
    assert "data/data_0.mcap" in lacking and "video/cameras_first_frame.yaml" not in lacking
    assert {d for d in os.listdir(root) if d.startswith("stage-")} == before


def test_discarding_only_what_the_block_staged(spark):
    kept = write_once(spark.range(3))
    with discard_staged(spark):
        gone = write_once(spark.range(4))
        assert gone.count() == 4
    assert kept.count() == 3
    with pytest.raises(Exception):  # noqa: B017
        gone.count()


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning")


def test_split_scan_shuffles_its_rows_once(spark, monkeypatch):
    """With broadcasts off: one exchange of the rows, one of the summaries."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    df = spark.range(400).selectExpr("cast(id % 3 AS string) AS k", "id AS ts", "id AS seq", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from robolog.operators.layout import Layout, Level, measure

        layout = measure(df, ["k"], ["ts", "seq"], 40)
        assert isinstance(layout, Layout) and all(isinstance(x, Level) for x in layout.levels)
        tagged = write_once(layout.tag(df))
        found = scan(df, ["k"], ["ts", "seq"], Layout(
            layout.keys, layout.order, layout.n_keys, layout.n_rows, layout.max_rows, layout.n_cells, layout.levels), n=row_number(), last=last_value("v"))
        tag_only = exchanges(layout.tag(df))
        # Tagging runs twice (rows, summaries); beyond that: rows by cell, summaries by cell, by key, and back by cell.
        assert exchanges(found) <= 2 * tag_only + 4
        assert tagged.count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counting_reads_no_payload(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "images")
    rows = [("a", i, i, "jpeg", b"\xff\xd8\xff" + bytes([i])) for i in range(20)]
    spark.createDataFrame(rows, "bag_id string, ts_ns bigint, seq bigint, encoding string, blob binary").write.parquet(path)
    shots = spark.read.parquet(path)
    clock = shots.select("bag_id", "ts_ns", "seq").where("seq % 2 = 0")
    seen = []
    real = align.measure
    monkeypatch.setattr(align, "measure", lambda df, *a: (seen.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *a))[1])
    shown = align_images(clock, shots)
    assert seen and all("blob" not in plan for plan in seen)
    assert [bytes(r.blob)[-1] for r in shown.orderBy("seq").collect()] == list(range(0, 20, 2))


def test_image_columns_are_picked_per_recording(spark):
    path = "/c"
    rows = [
        ("a", 1, 1, "/c:EncodedImage:blob", None, b"\x89PNG\r\n\x1a\n1"), ("a", 1, 2, "/c:EncodedImage:encoding", "webp", None),
        ("a", 2, 3, "/c:Other:x", None, b"no image"), ("b", 1, 1, "/c:Other:x", None, b"\x89PNG\r\n\x1a\n2"),
    ]
    df = spark.createDataFrame(rows, "bag_id string, ts_ns bigint, seq bigint, column_name string, encoding string, blob binary")
    clock = spark.createDataFrame([("a", 5, 9), ("b", 5, 9)], "bag_id string, ts_ns bigint, seq bigint")
    out = {r.bag_id: (bytes(r.blob)[-1:], r.media_type) for r in align_images(clock, df, column="column_name", path=path).collect()}
    assert out == {"a": (b"1", "image/webp"), "b": (b"2", "image/png")}


def test_frame_lookup_with_repeated_samples(spark):
    clock = spark.createDataFrame([("a", t, t) for t in (1, 5, 9)], "bag_id string, ts_ns bigint, seq bigint")
    shots = spark.createDataFrame([("a", 4, 1, "x"), ("a", 4, 1, "x"), ("a", 6, 2, None), ("a", 8, 3, "y")], "bag_id string, ts_ns bigint, seq bigint, sample string")
    for target in (None, 1):
        out = align.frame_lookup(clock, shots, target_rows=target).orderBy("ts_ns").collect()
        assert [r["sample"] for r in out] == ["x", "x", "y"]


def test_rejects_are_listed(spark):
    frames = spark.createDataFrame(
        [("a", c, i, i, float(i)) for c in ("l", "r") for i in range(3)] + [("b", "l", 1, 1, 1.0)],
        "bag_id string, camera string, ts_ns bigint, seq bigint, value double")
    assert align.camera_zip(frames, {"l": "left", "r": "right"}).select("bag_id").distinct().collect() == [("a",)]
    assert [tuple(r) for r in align.unequal_cameras(frames, ["l", "r"]).collect()] == [("b", 0, 1)]
    expected = spark.createDataFrame([("a", 4), ("c", 1)], "bag_id string, expected bigint")
    uneven = {r.bag_id: (r.n_rows, r.expected) for r in align.uneven_repeats(frames, expected).collect()}
    assert uneven == {"a": (6, 4), "b": (1, None), "c": (None, 1)}


def test_unknown_joint_names_fail(spark):
    rows = spark.createDataFrame([("Joint1_L", 0.0)], "joint string, angle double")
    with pytest.raises(ValueError, match="Elbow"):
        joints.joint_overrides(rows, {"Elbow": 1.0})
    items = spark.createDataFrame([("Joint1_L=0.5",), ("Joint1_L=0.7",)], "item string")
    assert joints.override_table(items) == {"Joint1_L": 0.7}
    with pytest.raises(ValueError, match="no value given"):
        joints.override_table(spark.createDataFrame([("x",)], "item string"))


def test_reindexing_by_the_schema_of_messages(spark):
    rows = [("a", "/x", None, None, 7, 1, [1.0], None, None, None, 9), ("a", "/x", None, None, None, 2, [1.0], None, None, None, 8), ("b", "/x", None, None, None, 3, None, None, None, None, None)]
    df = spark.createDataFrame(rows, MESSAGES)
    out = select.reindex_timeline(df, timeline_columns()).collect()
    assert [(r.bag_id, r.ts_ns, r.timeline) for r in out] == [("a", 7, "message_publish_time")]
    assert [r.bag_id for r in select.untimed_recordings(df, timeline_columns()).collect()] == ["b"]


def test_tied_rows_beyond_one_task_fail_clearly(spark, monkeypatch):
    from robolog.operators import layout

    monkeypatch.setattr(layout, "TARGET_ROWS", 5)
    df = spark.range(30).selectExpr("'a' AS k", "1L AS ts", "1L AS seq")
    with pytest.raises(ValueError, match="no order to be cut by"):
        layout.measure(df, ["k"], ["ts", "seq"], 5)


def test_medians_beyond_double_precision(spark):
    big = 2**60
    df = spark.createDataFrame([("a", big + i) for i in (1, 3, 6, 9)] + [("b", None)], "k string, v bigint")
    plain, split = (
        {r.k: (r._rows, r.m) for r in timeline.exact_median(df, ["k"], "v", "m", target).collect()} for target in (None, 1)
    )
    assert plain == split and plain["b"] == (1, None)


def test_rates_of_recordings(spark):
    frames = spark.createDataFrame([(b, i, i, f) for b, f in (("a", 30.0), ("b", 20.0), ("c", None)) for i in range(60)], "bag_id string, ts_ns bigint, seq bigint, fps double")
    out = {r.bag_id: r["count"] for r in timeline.downsample_fps(frames, "fps", 10.0).groupBy("bag_id").count().collect()}
    assert out == {"a": 20, "b": 30, "c": 20}


def test_parts_of_packets_stay_small():
    import inspect

    assert inspect.signature(images.concat_packets).parameters["part_bytes"].default <= 4 << 20


def test_dataset_plan_has_few_jobs_before_the_write(spark, tmp_path):
    from robolog.plans.dataset import build_dataset

    rows = spark.range(50).selectExpr("concat('s', id % 3) AS segment_id", "id AS ts_ns", "id AS seq", "array(cast(id AS double)) AS a", "array(cast(id AS double)) AS s")
    tracker, group = spark.sparkContext.statusTracker(), "jobs before the write"
    spark.sparkContext.setJobGroup(group, group)
    try:
        dataset = build_dataset(rows, ["a"], ["s"], action_dim=1, state_dim=1)
        before = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert dataset.frames.count() == 50
    assert before <= 16
    assert dataset.rejected.where(F.col("reason").isNotNull()).count() == 0


def on_disk(spark, folder, fault=None, fmt="parquet"):
    """A recording with every required file, two cameras and a log."""
    bag = "my_bag-24-05-01-10-00-00"
    for name in ("data/data_0.mcap", *CAMERA_FILES):
        os.makedirs(os.path.dirname(folder / "bags" / bag / name), exist_ok=True)
        (folder / "bags" / bag / name).write_bytes(b"x")
    (folder / "bags" / bag / "video" / "cameras_first_frame.yaml").write_text("first_frame_time:\n  epoch_ns: 1000\n")
    if fault == "file":
        (folder / "bags" / bag / "data" / "data_0.mcap").unlink()
    cameras = ["left_eye"] if fault == "camera" else ["left_eye", "right_eye"]
    step = 50 if fault == "rate" else 100
    frames = [(bag, c, i, i * step, 1, 1000, "h264", b"x") for c in cameras for i in range(4)]
    spark.createDataFrame(frames, FRAMES).write.parquet(str(folder / "frames"))
    messages = [(bag, p, None, None, 1000, 1, [1.0], None, None, None, None) for p in (JOINTS, POSE)]
    spark.createDataFrame(messages, MESSAGES).coalesce(1).write.json(str(folder / "messages"))
    if fault == "malformed":
        with open(folder / "messages" / "part-broken.json", "w") as file:
            file.write(f'{{"bag_id": "{bag}", "ts_ns": ]\n')
    return spark, str(folder / "bags"), str(folder / "messages"), str(folder / "frames")


@pytest.mark.parametrize("fault, reason", [
    (None, None), ("camera", "no right_eye frames"), ("rate", "clock does not run at 10 frames a second"), ("malformed", "malformed records"), ("file", None),
])
def test_a_fault_on_disk_is_listed_and_strict_raises(spark, tmp_path, fault, reason):
    given = on_disk(spark, tmp_path, fault)
    options = dict(topics=TOPICS, widths=WIDTHS, action_dim=1, fmt="json", cameras=("left_eye", "right_eye"), target_fps=10.0)
    output = str(tmp_path / "out")
    if fault is None:
        run_full(*given, output, strict=True, **options)
        assert read_dataset(spark, output).count() == 4
        assert [(r.n_rows, r.n_rejected, r.ok) for r in read_dataset(spark, output, "ingest_report").collect()] == [(2, 0, True)]
        return
    with pytest.raises(RuntimeError, match="rejected|no recording"):
        run_full(*given, output, strict=True, **options)
    assert not os.path.exists(output)
    if fault == "file":
        run_full(*given, output, **options)
        assert [r.name for r in read_dataset(spark, output, "missing_inputs").collect()] == ["data/data_0.mcap"]


def test_reasons_name_the_camera_the_rate_and_the_records(spark, tmp_path):
    bags, anchors, frames, messages = tables(spark)
    frames = frames.where("NOT (bag_id = 'b' AND camera = 'right_eye')")
    path = str(tmp_path / "out")
    known = spark.createDataFrame([("b", "malformed records"), (None, "malformed records")], "bag_id string, reason string")
    run_tables(bags, anchors, frames, messages, path, topics=TOPICS, widths=WIDTHS, action_dim=2, cameras=("left_eye", "right_eye"), target_fps=10_000.0, known_faults=known)
    status = {r.bag_id: list(r.reasons) for r in read_dataset(spark, path, "status").collect()}
    assert status["a"] == [] and status["b"] == ["no right_eye frames", "malformed records"] and "malformed records" in status[None]
    with pytest.raises(RuntimeError, match="no recording"):
        run_tables(*tables(spark), str(tmp_path / "slow"), topics=TOPICS, widths=WIDTHS, action_dim=2, target_fps=30.0)


def test_features_found_in_the_rows_are_published_with_names(spark, tmp_path):
    from robolog.plans.dataset import build_dataset, image_features, publish

    rows = spark.createDataFrame([(b, i, i, [1.0, 2.0], [float(i)]) for b in "xy" for i in range(3)], "segment_id string, ts_ns bigint, seq bigint, a array<double>, s array<double>")
    shapes = spark.createDataFrame(
        [("x", "left", 48, 64, 3), ("y", "left", 48, 64, 3), ("x", "right", 48, 64, 3), ("y", "right", 24, 64, 3), ("gone", "left", 1, 1, 1)],
        "segment_id string, camera string, height int, width int, channels int")
    dataset = build_dataset(rows, ["a"], ["s"], action_dim=2, state_dim=1, names={"action": ["j1", "j2"]}, packing="next_fit", file_mb=0.0001,
                            images=image_features(shapes, segment="segment_id"))
    path = str(tmp_path / "out")
    publish(dataset, path)
    found = {r.name: (r.dtype, list(r["shape"]), r.names) for r in read_dataset(spark, path, "features").collect()}
    assert found["action"] == ("float32", [2], ["j1", "j2"]) and found["observation_state"] == ("float32", [1], None)
    assert found["observation.images.left"] == ("video", [48, 64, 3], ["height", "width", "channels"])
    assert "observation.images.right" not in found and found["index"] == ("int64", [1], None) and len(found) == 8
    assert [r.file_index for r in read_dataset(spark, path, "episodes").orderBy("episode_index").collect()] == [0, 1]


def test_the_report_comes_with_the_writes(spark, tmp_path):
    from robolog.operators.quality import report_metrics, run_report
    from robolog.session import write_counted

    def jobs(work):
        group = f"count-{id(work)}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setJobGroup("rest", "rest")

    bags = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "bag_id string, ok boolean")
    (_, counts), observed = jobs(lambda: write_counted(bags, **report_metrics()))
    first, apart = jobs(lambda: run_report(write_once(bags)).first().asDict())
    assert counts == first == {"n_ok": 1, "n_failed": 2} and observed < apart
    path = str(tmp_path / "out")
    run_tables(*tables(spark, "clock"), path, topics=TOPICS, widths=WIDTHS, action_dim=2)
    assert read_dataset(spark, path, "run_report").first().asDict() == {"n_ok": 1, "n_failed": 1, "n_frames": 4, "n_episodes": 1}


def test_no_rows_are_counted_too(spark):
    from robolog.session import write_counted

    none = spark.createDataFrame([], "bag_id string, ok boolean")
    _, counts = write_counted(none.repartition(2, "bag_id").where("ok"), n=F.count(F.lit(1)))
    assert counts == {"n": 0}
