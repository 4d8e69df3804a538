import random

import pytest

from robolog.operators.packing import pack_files


def plain(sizes, target, file=0, used=None):
    """The sequential rule."""
    out = []
    for size in sizes:
        if used is not None and used + size >= target:
            file, used = file + 1, size
        else:
            used = (used or 0) + size
        out.append(file)
    return out


@pytest.mark.parametrize("seed, target, high", [(1, 100, 30), (2, 100, 250), (3, 10, 3), (4, 1, 5), (5, 10_000, 5)])
@pytest.mark.parametrize("target_rows", [None, 7])
def test_agrees_with_the_loop(spark, seed, target, high, target_rows):
    random.seed(seed)
    sizes = [random.choice([0, None, target, target - 1, random.randrange(high)]) if random.random() < 0.3 else random.randrange(high) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sizes)), "episode_index bigint, size_bytes bigint")
    out = pack_files(df, target_bytes=target, files_per_chunk=4, target_rows=target_rows).orderBy("episode_index").collect()
    assert [r.chunk_index * 4 + r.file_index for r in out] == plain([s or 0 for s in sizes], target)
    assert out[0].asDict().keys() == {"episode_index", "size_bytes", "chunk_index", "file_index"}


@pytest.mark.parametrize("filled", [1, 50, 99, 100])
def test_goes_on_in_a_begun_file(spark, filled):
    sizes = [30, 30, 60, 5, 5, 100, 20]
    df = spark.createDataFrame(list(enumerate(sizes)), "episode_index bigint, size_bytes bigint")
    out = pack_files(df, target_bytes=100, first_file=7, filled=filled).orderBy("episode_index").collect()
    assert [r.file_index for r in out] == plain(sizes, 100, 7, filled)


def test_no_episodes(spark):
    assert pack_files(spark.createDataFrame([], "episode_index bigint, size_bytes bigint"), target_bytes=5).count() == 0
