"""A stored log is worked on where it lies; packets that frames need."""

import random

import pytest

from robolog.functions.images import is_key_packet
from robolog.operators.align import asof_align
from robolog.operators.images import frame_packets
from robolog.sinks.store import DAY_NS, asof_in_store, read_store, write_store
from pyspark.sql import functions as F

TOPICS = {"/a": "a", "/b": "b"}


def some_log(spark):
    random.seed(3)
    rows = [(f"r{random.randrange(5)}", random.choice(["/clock", "/a", "/b", "/c"]), random.randrange(4) * DAY_NS + random.randrange(50), i, float(i)) for i in range(400)]
    return spark.createDataFrame(rows, "bag_id string, entity_path string, ts_ns bigint, seq bigint, value double")


@pytest.fixture
def store(spark, tmp_path):
    name = f"stored_{tmp_path.name}"
    yield name, some_log(spark)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_latest_values_without_an_exchange(spark, tmp_path, store):
    name, log = store
    write_store(log, name, str(tmp_path / "log"), buckets=3)
    out = asof_in_store(read_store(spark, name), "/clock", TOPICS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    clock = log.where("entity_path = '/clock'").select("bag_id", "ts_ns", "seq")
    want = asof_align(clock, log, TOPICS)
    assert sorted(map(tuple, out.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    counts = read_store(spark, name).groupBy("bag_id").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    split = asof_in_store(read_store(spark, name), "/clock", TOPICS, target_rows=20)
    assert sorted(map(tuple, split.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_time_range_reads_its_days_only(spark, tmp_path, store):
    name, log = store
    write_store(log, name, str(tmp_path / "log"), buckets=3)
    start, end = DAY_NS + 10, 2 * DAY_NS
    part = read_store(spark, name, start, end)
    files = {r.f for r in part.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert files and all("/day=1/" in f for f in files)
    assert "PartitionFilters: [isnotnull(day" in part._jdf.queryExecution().executedPlan().toString()
    assert part.count() == log.where(f"ts_ns >= {start} AND ts_ns < {end}").count()


@pytest.mark.parametrize("codec, data, want", [
    ("h264", b"\x00\x00\x01\x65x", True), ("h264", b"\x00\x00\x00\x01\x67s\x00\x00\x01\x25", True), ("h264", b"\x00\x00\x01\x41\x65", False),
    ("h265", b"\x00\x00\x01\x26\x01", True), ("h265", b"\x00\x00\x01\x02\x01", False), ("h264", b"", False), ("h264", None, False), ("h264", b"\xff\xfe\n\x00\x00\x01\x05", True),
])
def test_key_packets_by_their_bytes(spark, codec, data, want):
    df = spark.createDataFrame([(data,)], "p binary")
    assert df.select(is_key_packet(F.col("p"), codec)).first()[0] is want


def test_ranges_of_frames_are_merged_per_group(spark):
    key, other = b"\x00\x00\x01\x65", b"\x00\x00\x01\x41"
    packets = [("s", i * 10, 0, key if i in (2, 5) else other) for i in range(8)] + [("t", 0, 0, other)]
    wanted = [("s", 5), ("s", 39), ("s", 30), ("s", 45), ("s", 999), ("t", -5), ("gone", 1)]
    out = frame_packets(spark.createDataFrame(wanted, "stream string, ts_ns bigint"), spark.createDataFrame(packets, "stream string, ts_ns bigint, seq bigint, packet binary"))
    found = sorted((r.stream, r.packet_no, r.group_no, r.shown) for r in out.collect())
    assert found == [("s", 0, 0, 1), ("s", 2, 1, 0), ("s", 3, 1, 2), ("s", 4, 1, 1), ("s", 5, 2, 0), ("s", 6, 2, 0), ("s", 7, 2, 1), ("t", 0, 0, 1)]
