import datetime
import json
import re

import pytest
from pyspark.sql import functions as F, types as T

from robolog.contracts import MESSAGES, ExportSpec, column_preferences, training_contents
from robolog.functions import images as img
from robolog.functions import times
from robolog.operators import images, quality, select
from robolog.plans.dataset import run_full
from robolog.session import scratch_root
from robolog.sinks.publish import read_dataset
from robolog.sources import catalog, log


@pytest.fixture
def bags(tmp_path):
    """Two recordings, one without its clock anchor, and a stray folder."""
    for name, files in {
        "my_bag-24-05-01-10-00-00": ["data/data_0.mcap", "video/cameras.mp4", "video/cameras_first_frame.yaml"],
        "my_bag-24-04-01-10-00-00": ["data/data_0.mcap", "video/left_eye.mp4"],
        "other": ["video/cameras.mp4"],
    }.items():
        for file in files:
            path = tmp_path / name / file
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("first_frame_time:\n  epoch_ns: 100\n" if file.endswith("yaml") else "12345")
    return str(tmp_path)


def test_catalog(spark, bags):
    files = catalog.list_files(spark, bags)
    out = {r.bag_id: r for r in catalog.bag_catalog(files).collect()}
    assert set(out) == {"my_bag-24-05-01-10-00-00", "my_bag-24-04-01-10-00-00"}
    first = out["my_bag-24-05-01-10-00-00"]
    assert (first.n_files, first.n_tiled_videos, first.bag_ts) == (3, 1, "24-05-01-10-00-00")
    assert catalog.earliest_bag(catalog.bag_catalog(files)).first().bag_ts == "24-04-01-10-00-00"
    assert catalog.tiled_videos(files).count() == 2
    missing = {(r.bag_id[7:15], r.name) for r in catalog.missing_files(files).collect()}
    assert ("24-04-01", "video/cameras_first_frame.yaml") in missing
    assert ("24-05-01", "video/left_eye.mp4") in missing and ("24-04-01", "video/left_eye.mp4") not in missing


def test_listing_reads_no_content(spark, bags):
    plan = catalog.list_files(spark, bags)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_anchors(spark, bags):
    assert [(r.bag_id, r.first_frame_epoch_ns) for r in catalog.read_anchors(spark, bags).collect()] == [
        ("my_bag-24-05-01-10-00-00", 100)
    ]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("first_frame_time:\n  epoch_ns: 17\n", 17),
        ("a: 1\nfirst_frame_time:\n  sec: 4\n\n  nanosec: 5\n  epoch_ns: '18'\nb: 2\n", 18),
        ("first_frame_time: {sec: 4, epoch_ns: 19}\n", 19),
        ("first_frame_time:\n  sec: 4\nlast_frame_time:\n  epoch_ns: 20\n", None),
        ("epoch_ns: 21\n", None),
        ("", None),
    ],
)
def test_anchor_text(spark, text, expected):
    df = spark.createDataFrame([("a", text)], "bag_id string, text string")
    assert catalog.clock_anchor(df).first().first_frame_epoch_ns == expected
    if expected is None:
        with pytest.raises(Exception, match="no first_frame_time.epoch_ns for a"):
            catalog.clock_anchor(df, strict=True).collect()


def test_malformed_messages(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"bag_id": "a", "seq": 1}) + "\n{broken\n")
    rows = log.read_messages(spark, str(path), fmt="json")
    report = log.ingest_report(rows).collect()
    assert {(r.bag_id, r.n_rows, r.ok) for r in report} == {("a", 1, True), (None, 1, False)}
    with pytest.raises(Exception):
        log.read_messages(spark, str(path), fmt="json", strict=True).collect()


def test_partitions_are_pruned_and_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("a", "/x", 1), ("b", "/y", 2)], "bag_id string, entity_path string, seq bigint").write.partitionBy("bag_id").parquet(path)
    rows = log.read_messages(spark, path)
    chosen = select.filter_segments(select.filter_contents(rows, ["/x", "/v/**"]), ["a"]).select("seq")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bag_id", plan) and "StringStartsWith(entity_path,/v/)" in plan
    assert "ReadSchema: struct<entity_path:string,seq:bigint>" in plan
    assert chosen.count() == 1
    names = {r.segment_id for r in log.segment_files(rows).collect()}
    assert all(n.endswith(".parquet") for n in names)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


# --- selection ---------------------------------------------------------------------------


def test_spec_paths():
    spec = ExportSpec(
        action=["/a:S:s", "/b:S:s"], state=["/b:T:t", "/c:S:s"], task="/t:D:text", cameras={"front": "/v"}
    )
    assert select.spec_paths(spec) == ["/a", "/b", "/c", "/t", "/v"]
    assert select.clock_path(spec) == "/a"


def test_subtrees():
    assert training_contents("hand")[-2:] == ["/video_stream/**", "/language_instruction"]


def test_contents(spark):
    paths = ["/v", "/v/a", "/va", "/x", "/x/y"]
    df = spark.createDataFrame([(p,) for p in paths], "entity_path string")
    out = [r[0] for r in select.filter_contents(df, ["/v/**", "/x"]).collect()]
    assert out == ["/v", "/v/a", "/x"]


def test_column_choice(spark):
    left, grip = "/info/eef_left", "/info/gripper_feedback_L"
    names = [
        ("a", left, f"{left}:Scalars:scalars"), ("a", left, f"{left}:InstancePoses3D:quaternions"),
        ("b", left, f"{left}:Scalars:scalars"), ("a", grip, f"{grip}:McapChannel:topic"), ("a", grip, f"{grip}:Other:x"),
        ("b", grip, f"{grip}:McapChannel:topic"),
    ]
    df = spark.createDataFrame(names, "bag_id string, entity_path string, column_name string")
    out = {(r.bag_id, r.entity_path, r.position): r.column_name for r in select.pick_columns(df, column_preferences("gripper")).collect()}
    assert out == {
        ("a", left, 0): f"{left}:InstancePoses3D:quaternions",
        ("a", left, 1): f"{left}:Scalars:scalars",
        ("b", left, 0): f"{left}:Scalars:scalars",
        ("a", grip, 0): f"{grip}:Other:x",
    }


def test_image_column_choice(spark):
    columns = ["/c:McapSchema:encoding", "/c:McapChannel:message", "/c:EncodedImage:blob", "/c:EncodedImage:encoding"]
    rows = [("a", c) for c in columns] + [("b", "/c:x:y"), ("c", "/d:EncodedImage:blob")]
    df = spark.createDataFrame(rows, "bag_id string, column_name string")
    found = {r.bag_id: (r.image_column, r.codec_column) for r in select.pick_image_columns(df, "/c").collect()}
    assert found == {"a": ("/c:EncodedImage:blob", "/c:McapSchema:encoding"), "b": ("/c:x:y", None)}


def test_timeline_choice(spark):
    df = spark.createDataFrame([("a", "tick"), ("a", "ros2_timestamp"), ("b", "tick"), ("b", "blip")], "bag_id string, timeline string")
    assert {(r.bag_id, r.timeline) for r in select.pick_timeline(df).collect()} == {("a", "ros2_timestamp"), ("b", "blip")}


def test_segments(spark):
    df = spark.createDataFrame([("r", "s1", b""), ("r", "s2", b"x"), ("r", "s3", None)], "rec string, seg string, p binary")
    table = df.withColumn("t", F.lit(1)).transform(lambda d: select.segment_table(d, segment="seg", payload="p", ts="t"))
    assert [r.seg for r in select.nonempty_segments(df, table, "seg").collect()] == ["s2"]
    assert [r.seg for r in select.last_segment(df, "rec", "seg").collect()] == ["s3"]
    assert sorted(r.seg for r in select.first_segments(df, 2, "seg").collect()) == ["s1", "s2"]


def test_segment_sizes_come_from_the_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"s{i % 3}", bytes(200 + i)) for i in range(30)], "ts_ns bigint, seg string, payload binary")
    df.repartition(3, "seg").write.parquet(str(tmp_path / "log"))
    found = select.segment_files_table(spark.read.parquet(str(tmp_path / "log")))
    on_disk = {p.name: p.stat().st_size for p in (tmp_path / "log").glob("*.parquet")}
    rows = found.collect()
    assert {r.segment_id: r.size_bytes for r in rows}.items() <= on_disk.items() and sum(r.n_rows for r in rows) == 30
    assert min(r.first_ns for r in rows) == 0 and max(r.last_ns for r in rows) == 29
    scanned = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line]
    assert scanned and not any("payload" in line for line in scanned)


def test_error_policy(spark):
    some = spark.createDataFrame([(True,), (False,), (None,)], "ok boolean")
    report = quality.run_report(some)
    assert tuple(report.first()) == (1, 2)
    quality.require(report, strict=False)
    with pytest.raises(RuntimeError):
        quality.require(report, strict=True)
    with pytest.raises(RuntimeError):
        quality.require(quality.run_report(some.where("not ok")), strict=False)


# --- times and images ----------------------------------------------------------------------


def value(spark, v, ddl, function):
    dtype = T.StructType.fromDDL(f"v {ddl}")
    df = spark.createDataFrame([(v,)], dtype)
    return df.select(function(F.col("v"), dtype["v"].dataType).alias("x")).first().x


def test_times_in_any_zone(spark):
    stamp = datetime.datetime(2024, 3, 10, 2, 30, 0, 5)  # does not exist in New York
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert value(spark, stamp, "timestamp_ntz", times.normalize_time) == 1710037800000005000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert value(spark, 1.5, "double", times.normalize_time) == 1_500_000_000
    assert value(spark, 7, "bigint", times.normalize_time) == 7
    span = datetime.timedelta(days=2, seconds=3, microseconds=4)
    assert value(spark, span, "interval day to second", times.normalize_time) == 172803000004000


def test_frame_time_is_cut_to_whole_ns(spark):
    df = spark.createDataFrame([(10**18, 3, 1001, 30000)], "a bigint, p bigint, n int, d int")
    at = times.frame_time(F.col("a"), F.col("p"), F.col("n"), F.col("d"))
    assert df.select(at.alias("x")).first().x == 10**18 + 100100000


def test_names(spark):
    df = spark.createDataFrame([("my_bag-24-01-02-03-04-05",), ("plain",)], "n string")
    out = df.select(times.bag_timestamp(F.col("n")).alias("x"), times.name_timestamp(F.col("n"), "my_bag-", "-05").alias("y")).collect()
    assert [(r.x, r.y) for r in out] == [("24-01-02-03-04-05", "24-01-02-03-04"), ("plain", None)]
    parsed = df.select(times.parse_bag_timestamp(times.bag_timestamp(F.col("n"))).alias("x")).collect()
    assert [r.x for r in parsed] == [datetime.datetime(2024, 1, 2, 3, 4, 5), None]


def test_task_text(spark):
    assert value(spark, None, "string", times.task_text) == "task"
    assert value(spark, "é".encode(), "binary", times.task_text) == "é"
    assert value(spark, ["x"], "array<string>", times.task_text) == "x"
    assert value(spark, None, "string", lambda c, d: times.task_text(c, d, override="x")) == "x"


def test_image_bytes(spark):
    def data(v, ddl):
        out = value(spark, v, ddl, img.image_bytes)
        return None if out is None else bytes(out)
    assert data(b"\x01", "binary") == b"\x01" and data(b"", "binary") is None
    assert data(" YWJj ", "string") == b"abc"
    assert data("abc", "string") == b"abc"
    assert data("a-c!", "string") == b"a-c!"
    assert data("", "string") is None
    assert data([1, 255, 0], "array<int>") == b"\x01\xff\x00"
    assert data([1, 256], "array<int>") is None
    assert data((5, b"z"), "struct<n: int, payload: binary>") == b"z"
    assert data((None, "YWJj"), "struct<a: binary, b: string>") == b"abc"
    assert data([b"", b"q"], "array<binary>") == b"q"


def test_codecs(spark):
    def codec(b):
        return value(spark, b, "binary", lambda c, d: img.codec_from_bytes(c))
    assert codec(b"\xff\xd8\xff1") == "jpeg" and codec(b"\x89PNG\r\n\x1a\n") == "png"
    assert codec(b"RIFF1234WEBP") == "webp" and codec(b"RIFF1234WEB") == "jpeg"
    assert codec(b"\x00\x00\x01x") == "h264" and codec(b"") == "jpeg" and codec(None) == "jpeg"
    def name(n):
        return value(spark, n, "string", lambda c, d: img.codec_from_name(c))
    assert [name(n) for n in ("sensor/JPG", "cdr", "video-avc", "WebP", "", None)] == ["jpeg", None, "h264", "webp", None, None]


def test_tiles_of_odd_sizes(spark):
    frames = spark.createDataFrame(
        [(5, 3, 1, bytes(range(15))), (1, 9, 1, bytes(9))], "width int, height int, channels int, pixels binary"
    )
    out = {r.camera: ((r.r0, r.r1, r.c0, r.c1), bytes(r.tile)) for r in images.tile_crop(frames).collect()}
    assert out == {
        "left_eye": ((0, 1, 0, 2), bytes([0, 1])),
        "right_eye": ((0, 1, 2, 5), bytes([2, 3, 4])),
        "left_wrist": ((1, 3, 0, 2), bytes([5, 6, 10, 11])),
        "right_wrist": ((1, 3, 2, 5), bytes([7, 8, 9, 12, 13, 14])),
    }


@pytest.mark.parametrize("size,a,b,expected", [(10, 0.3, 0.3, (3, 7)), (1, 0.9, 0.9, (0, 1)), (2, 0.5, 0.5, (1, 2)), (3, 1.0, 1.0, (2, 3))])
def test_inner_bounds(spark, size, a, b, expected):
    df = spark.createDataFrame([(size,)], "n int")
    got = df.select(img.inner_bounds(F.col("n"), a, b).alias("x")).first().x
    assert (got.first, got.end) == expected


@pytest.mark.parametrize("target", [50_000, 3])
def test_packet_parts_make_the_stream(spark, target):
    rows = [("s", i, bytes([i]) * (i % 7)) for i in range(100)] + [("t", 1, b"one")]
    df = spark.createDataFrame(rows, "stream string, seq bigint, packet binary")
    parts = images.concat_packets(df, order=("seq",), part_bytes=20, target_rows=target).orderBy("stream", "part").collect()
    whole = b"".join(bytes(r.data) for r in parts if r.stream == "s")
    assert whole == b"".join(p for s, _, p in rows if s == "s")
    assert max(len(r.data) for r in parts) < 20 + 6


# --- the whole run ---------------------------------------------------------------------------


def test_run_full(spark, bags, tmp_path):
    """Anchors, camera frames and messages in; a dataset folder out."""
    good = "my_bag-24-05-01-10-00-00"
    frames = [(good, "left_eye", i, i, 1, 10, "h264", b"x") for i in range(5)]
    schema = "bag_id string, camera string, frame_no bigint, pts bigint, tb_num int, tb_den int, codec string, sample binary"
    spark.createDataFrame(frames, schema).write.parquet(str(tmp_path / "in" / "frames"))
    widths = {
        "/joint_states/effort": 14, "/joint_states/position": 14, "/joint_states/velocity": 14,
        "/info/eef_left": 7, "/info/eef_right": 7, "/info/gripper_feedback_L": 5, "/info/gripper_feedback_R": 5,
    }
    messages = [
        (good, path, None, 100 + step * 100_000_000, None, step, [float(step)] * n, None, None, None, None)
        for path, n in widths.items()
        for step in range(1, 4)
    ]
    spark.createDataFrame(messages, MESSAGES).write.parquet(str(tmp_path / "in" / "messages"))
    output = str(tmp_path / "out")
    given = (spark, bags, str(tmp_path / "in" / "messages"), str(tmp_path / "in" / "frames"))
    # The folder holds a recording without an anchor, which strict must not pass over.
    with pytest.raises(RuntimeError, match="rejected"):
        run_full(*given, output, strict=True)
    run_full(*given, output)
    rejected = read_dataset(spark, output, "status").where("NOT ok").collect()
    assert rejected and all("no clock anchor" in r.reasons for r in rejected)
    rows = read_dataset(spark, output).orderBy("frame_index").collect()
    assert [r.action[0] for r in rows] == [0.0, 1.0, 2.0, 3.0, 3.0]
    assert all(len(r.action) == 42 and len(r.observation_state) == 26 for r in rows)
    assert [round(r.timestamp, 3) for r in rows] == [0.0, 0.1, 0.2, 0.3, 0.4]
