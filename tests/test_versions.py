"""Publishing in versions, appending, and what readers see when a writer fails."""

import os

import pytest
from pyspark.sql import functions as F

from robolog.plans.dataset import append_dataset, build_dataset, publish
from robolog.sinks.publish import read_dataset
from robolog.sinks.versions import commit, compact, expire, load_version, publishing, read_version, version_numbers, version_sizes

ROWS = "segment_id string, ts_ns bigint, seq bigint, text string, a array<double>, s array<double>"
OPTIONS = {"action_dim": 1, "state_dim": 2, "task": "text", "file_mb": 0.0001}


def some(spark, names, n=3):
    rows = [(name, i, i, f"task {(i + len(name) + ord(name[-1])) % 5}", [float(i)], [1.0, float(i)]) for name in names for i in range(n)]
    return spark.createDataFrame(rows, ROWS)


def build(spark, names, **more):
    return build_dataset(some(spark, names), ["a"], ["s"], **OPTIONS, **more)


def held(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


FRAME = ("segment_id", "episode_index", "frame_index", "index", "task_index", "chunk_index", "file_index")


def test_batches_give_the_rows_of_one_run(spark, tmp_path):
    one, grown = str(tmp_path / "one"), str(tmp_path / "grown")
    publish(build(spark, ["a", "b", "c", "d", "e"]), one)
    publish(build(spark, ["a", "b"]), grown)
    append_dataset(spark, grown, some(spark, ["c"]), ["a"], ["s"], **OPTIONS)
    append_dataset(spark, grown, some(spark, ["d", "e"]), ["a"], ["s"], **OPTIONS)
    assert version_numbers(spark, grown) == [1, 2, 3]
    for table, columns in (("data", FRAME), ("tasks", ("task_index", "task")), ("episodes", ("segment_id", "episode_index", "length", "first_index", "file_index")),
                           ("info", ("total_episodes", "total_frames", "total_tasks")), ("episode_tasks", ("episode_index", "position", "task"))):
        assert held(read_dataset(spark, grown, table), *columns) == held(read_dataset(spark, one, table), *columns), table
    files = read_dataset(spark, grown, "episode_files").collect()
    assert len(files) == 5 and all(os.path.exists(f"{grown}/{f.path}") for f in files)
    # An earlier version is still what it was.
    assert read_dataset(spark, grown, version=1).count() == 6 and read_dataset(spark, grown, "tasks", 1).count() <= 4


def test_a_recording_twice_is_refused(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(build(spark, ["a", "b"]), path)
    with pytest.raises(ValueError, match="already in .*: b"):
        append_dataset(spark, path, some(spark, ["b", "c"]), ["a"], ["s"], **OPTIONS)
    with pytest.raises(ValueError, match="vectors of 1 and 2"):
        append_dataset(spark, path, some(spark, ["c"]), ["a", "a"], ["s"], **{**OPTIONS, "action_dim": 2})
    with pytest.raises(FileNotFoundError):
        append_dataset(spark, str(tmp_path / "none"), some(spark, ["c"]), ["a"], ["s"], **OPTIONS)
    assert version_numbers(spark, path) == [1]


@pytest.mark.parametrize("where", ["frames", "meta"])
def test_a_failure_mid_way_leaves_the_old_version(spark, tmp_path, where):
    path = str(tmp_path / "out")
    publish(build(spark, ["a", "b"]), path)
    dataset = build(spark, ["c", "d", "e"])
    fails = F.when(F.col("episode_index") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("episode_index")).cast("bigint")
    parts = {"frames": dataset.frames, "episodes": dataset.episodes}
    name = "frames" if where == "frames" else "episodes"
    parts[name] = parts[name].withColumn("episode_index", fails)
    with pytest.raises(Exception, match="lost"):
        publish(type(dataset)(parts["frames"], parts["episodes"], dataset.tasks, dataset.rejected, dataset.info), path, replace=True)
    assert held(read_dataset(spark, path), "segment_id", "index") == [("a", 0), ("a", 1), ("a", 2), ("b", 3), ("b", 4), ("b", 5)]
    assert read_dataset(spark, path, "episodes").count() == 2 and version_numbers(spark, path) == [1]
    assert len([d for d in os.listdir(f"{path}/data") if d.startswith("batch=")]) == 1


def test_files_of_a_writer_that_died_are_not_seen_and_expire(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(build(spark, ["a"]), path)
    build(spark, ["z"]).frames.write.partitionBy("chunk_index", "file_index").parquet(f"{path}/data/batch=b-dead")
    assert read_dataset(spark, path).count() == 3
    publish(build(spark, ["b", "c"]), path, replace=True)
    assert read_dataset(spark, path).count() == 6 and read_dataset(spark, path, version=1).count() == 3
    assert expire(spark, path) == [1]
    assert len([d for d in os.listdir(f"{path}/data") if d.startswith("batch=")]) == 1 and read_dataset(spark, path).count() == 6
    with pytest.raises(ValueError, match="no version 1"):
        read_version(spark, path, number=1)


def test_of_two_writers_the_second_fails(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(build(spark, ["a"]), path)
    with pytest.raises(RuntimeError, match="another writer"):
        with publishing(spark, path, "append") as batch:
            some(spark, ["x"]).write.parquet(f"{path}/data/batch={batch}")
            commit(spark, path, load_version(spark, path).batches, 1)  # the other one was faster
    assert version_numbers(spark, path) == [1, 2] and not os.path.exists(f"{path}/data/batch={batch}")
    assert read_dataset(spark, path).count() == 3
    with pytest.raises(ValueError, match="mode is one of"), publishing(spark, path, "other"):
        pass


def test_compacting_keeps_rows_and_joins_files(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(build_dataset(some(spark, ["a"]), ["a"], ["s"], **{**OPTIONS, "file_mb": 1.0}), path)
    append_dataset(spark, path, some(spark, ["b"]), ["a"], ["s"], **{**OPTIONS, "file_mb": 1.0})
    before = held(read_dataset(spark, path), *FRAME)
    assert len({r.path.rsplit("/", 1)[0] for r in read_dataset(spark, path, "episode_files").collect()}) == 2
    version = compact(spark, path)
    assert version.number == 3 and len(version.batches) == 1
    assert held(read_dataset(spark, path), *FRAME) == before
    assert len({r.path.rsplit("/", 1)[0] for r in read_dataset(spark, path, "episode_files").collect()}) == 1
    assert held(version_sizes(spark, path), "version", "n_batches", "n_frames", "n_episodes") == [(1, 1, 3, 1), (2, 2, 6, 2), (3, 1, 6, 2)]
