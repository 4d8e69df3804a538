import pytest
from pyspark.sql import functions as F

from robolog.operators import episodes
from robolog.plans.dataset import build_dataset, episode_frames, publish
from robolog.sinks.publish import read_dataset, write_by_bag

ROWS = "segment_id string, ts_ns bigint, seq bigint, text string, a array<double>, s array<double>"


def data(spark):
    return spark.createDataFrame(
        [
            ("s2", 30, 1, "pick", [1.0], [5.0, 6.0]),
            ("s2", 10, 2, None, [2.0], [5.0, 7.0]),
            ("s2", 20, 3, "place", None, [5.0, 6.0]),
            ("s1", 5, 4, "pick", None, [1.0, 1.0]),
            ("s3", 9, 5, "place", [4.0], [0.0, 1.0]),
            ("s3", 1_500_000_009, 6, "pick", [6.0], [0.0, 3.0]),
        ],
        ROWS,
    )


def test_numbering_skips_empty_episodes(spark):
    frames, table, tasks = episode_frames(data(spark), ["a"], ["s"], task="text")
    got = [
        (r.segment_id, r.episode_index, r.frame_index, r["index"], r.timestamp, r.task, r.task_index)
        for r in frames.orderBy("index").collect()
    ]
    assert got == [
        ("s2", 0, 0, 0, 0.0, "task", 0),
        ("s2", 0, 1, 1, pytest.approx(2e-8), "pick", 1),
        ("s3", 1, 0, 2, 0.0, "place", 2),
        ("s3", 1, 1, 3, 1.5, "pick", 1),
    ]
    assert [(r.segment_id, r.length, r.first_index) for r in table.orderBy("episode_index").collect()] == [
        ("s2", 2, 0), ("s3", 2, 2)
    ]
    assert {(r.task_index, r.task) for r in tasks.collect()} == {(0, "task"), (1, "pick"), (2, "place")}


def test_text_override(spark):
    frames, _, tasks = episode_frames(data(spark), ["a"], ["s"], task="text", task_override="x")
    assert {r.task for r in frames.collect()} == {"x"} and tasks.count() == 1


def test_index_has_no_gaps_with_a_hot_episode(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("segment_id"),
        F.col("id").alias("ts_ns"), F.col("id").alias("seq"),
        F.array(F.col("id").cast("double")).alias("a"), F.array(F.lit(0.0)).alias("s"),
    )
    plain, _, _ = episode_frames(rows, ["a"], ["s"])
    split, _, _ = episode_frames(rows, ["a"], ["s"], target_rows=100)
    assert sorted(r["index"] for r in split.collect()) == list(range(4000))
    names = ["segment_id", "ts_ns", "episode_index", "frame_index", "index", "timestamp"]
    assert plain.select(names).exceptAll(split.select(names)).isEmpty()


def test_tasks_in_first_seen_order(spark):
    rows = spark.createDataFrame(
        [("e", 3, "b"), ("e", 1, "c"), ("e", 2, "b"), ("e", 4, "a"), ("f", 1, "a")],
        "segment_id string, frame_index bigint, task string",
    )
    for target in (None, 1):
        out = episodes.episode_tasks(rows, order=("frame_index",), target_rows=target)
        assert {(r.segment_id, r.position, r.task) for r in out.collect()} == {
            ("e", 0, "c"), ("e", 1, "b"), ("e", 2, "a"), ("f", 0, "a")
        }


def test_file_assignment(spark):
    sizes = spark.createDataFrame([(i, 600 * 1024) for i in range(5)], "episode_index bigint, size_bytes bigint")
    out = episodes.file_assignment(sizes, target_mb=1.0, files_per_chunk=2).orderBy("episode_index").collect()
    assert [(r.chunk_index, r.file_index) for r in out] == [(0, 0), (0, 0), (0, 1), (0, 1), (1, 0)]
    assert out[4].path == "data/chunk-001/file-000.parquet"


def test_dataset_on_disk(spark, tmp_path):
    rows = data(spark).unionByName(
        spark.createDataFrame([("bad", 1, 7, "x", [1.0, 2.0], [1.0, 1.0]), ("bad", 2, 8, "x", [1.0], [1.0, 1.0])], ROWS)
    )
    dataset = build_dataset(rows, ["a"], ["s"], action_dim=1, state_dim=2, task="text", file_mb=1.0)
    assert [(r.segment_id, r.n_bad) for r in dataset.rejected.collect()] == [("bad", 1)]
    path = str(tmp_path / "out")
    publish(dataset, path)
    frames = read_dataset(spark, path)
    assert frames.count() == 4 and "bad" not in {r.segment_id for r in frames.collect()}
    stats = {(r.episode_index, r.feature): r for r in read_dataset(spark, path, "stats").collect()}
    state = stats[(1, "observation_state")]
    assert (state["min"], state["max"], state["mean"], state["std"]) == ([0, 1], [0, 3], [0, 2], [0, 1])
    assert read_dataset(spark, path, "episode_tasks").count() == 4
    with pytest.raises(Exception, match="(?i)already exists"):
        publish(dataset, path)
    publish(dataset, path, replace=True)
    assert read_dataset(spark, path).count() == 4


def test_replacing_some_recordings(spark, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "bag_id string, ts_ns bigint, v string")
    write_by_bag(first, path)
    write_by_bag(spark.createDataFrame([("b", 2, "new")], "bag_id string, ts_ns bigint, v string"), path)
    assert {(r.bag_id, r.v) for r in spark.read.parquet(path).collect()} == {("a", "old"), ("b", "new")}
