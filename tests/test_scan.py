import random

import pytest
from pyspark.sql import functions as F

from robolog.operators.layout import measure
from robolog.operators.scan import (
    lag,
    last_value,
    next_value,
    numbered,
    numbered_by_range,
    row_number,
    running_sum,
    scan,
)
from robolog.session import materialize

SCANS = dict(
    n=row_number(), total=running_sum("v"), last=last_value("v"), next=next_value("v"), before=lag("v")
)


def rows(seed, n, hot_share=0.4, bursts=True):
    """One key holds a large share of the rows, much of it in a burst and on one instant."""
    rnd = random.Random(seed)
    out = []
    for seq in range(n):
        key = "hot" if rnd.random() < hot_share else f"k{rnd.randrange(7)}"
        kind = rnd.random()
        if bursts and kind < 0.4:
            ts = 1_000_000_000_000_000_000 + rnd.randrange(40)
        elif bursts and kind < 0.6:
            ts = 1_000_000_000_000_000_777
        else:
            ts = 1_000_000_000_000_000_000 + rnd.randrange(10**15)
        out.append((key, ts, seq, None if rnd.random() < 0.5 else rnd.randrange(100)))
    return out


def brute(data):
    by_key = {}
    for row in data:
        by_key.setdefault(row[0], []).append(row)
    expected = []
    for group in by_key.values():
        group.sort(key=lambda r: (r[1], r[2]))
        total = last = before = None
        nexts, following = [], None
        for row in reversed(group):
            following = row[3] if row[3] is not None else following
            nexts.append(following)
        nexts.reverse()
        for i, row in enumerate(group):
            if row[3] is not None:
                total = row[3] + (total or 0)
                last = row[3]
            expected.append((*row, i + 1, total, last, nexts[i], before))
            before = row[3]
    return sorted(expected, key=lambda r: r[2])


def run(df, **options):
    found = scan(df, ["k"], ["ts", "seq"], **options, **SCANS)
    names = ["k", "ts", "seq", "v", "n", "total", "last", "next", "before"]
    return [tuple(r) for r in found.select(*names).orderBy("seq").collect()]


@pytest.mark.parametrize("seed,target", [(1, None), (1, 20), (2, 7), (3, 150), (4, 1)])
def test_scans_match_brute_force(spark, seed, target):
    data = rows(seed, 600)
    df = spark.createDataFrame(data, "k string, ts bigint, seq bigint, v bigint")
    assert run(df, target_rows=target) == brute(data)


def test_null_key_is_a_key(spark):
    data = [(None if r[0] == "hot" else r[0], *r[1:]) for r in rows(5, 300)]
    df = spark.createDataFrame(data, "k string, ts bigint, seq bigint, v bigint")
    assert run(df, target_rows=10) == run(df)


def test_cells_are_bounded_and_ordered(spark):
    df = spark.createDataFrame(rows(6, 3000), "k string, ts bigint, seq bigint, v bigint")
    layout = measure(df, ["k"], ["ts", "seq"], 50)
    assert layout.split and layout.n_keys == 8 and layout.n_rows == 3000
    tagged = layout.tag(df)
    fullest = tagged.groupBy("k", *layout.cells).count().agg(F.max("count")).first()[0]
    assert fullest <= 50
    assert tagged.count() == 3000
    order = [
        (r.k, tuple(r[c] for c in layout.cells), r.ts, r.seq) for r in tagged.orderBy("k", "ts", "seq").collect()
    ]
    assert order == sorted(order, key=lambda r: (r[0], r[1]))


def test_no_split_without_a_full_key(spark):
    df = spark.createDataFrame(rows(7, 200), "k string, ts bigint, seq bigint, v bigint")
    layout = measure(df, ["k"], ["ts", "seq"], 500)
    assert not layout.split
    plan = scan(df, ["k"], ["ts", "seq"], layout, n=row_number(), last=last_value("v"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1 and text.count("Window ") == 1


def test_same_under_other_partition_counts(spark):
    df = spark.createDataFrame(rows(8, 400), "k string, ts bigint, seq bigint, v bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(run(df, target_rows=30))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_numbering_of_small_tables(spark):
    data = [(f"s{i:03d}", i % 5 + 1) for i in range(200)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "name string, size bigint")
    one = numbered(df, "name", "i", start="size").orderBy("name").collect()
    many = numbered_by_range(materialize(df), "name", "i", 7, {"start": "size"}).orderBy("name")
    assert [tuple(r) for r in one] == [tuple(r) for r in many.select("name", "size", "i", "start").collect()]
    at = 0
    for i, r in enumerate(one):
        assert (r.i, r.start) == (i, at)
        at += r["size"]


def test_large_sides_are_not_broadcast(spark, monkeypatch):
    """The same rows come out of the broadcast and the shuffle join."""
    from robolog.operators import joins

    df = spark.createDataFrame(rows(9, 300), "k string, ts bigint, seq bigint, v bigint")
    side = df.groupBy("k").agg(F.min("ts").alias("first"), F.max(F.col("k")).alias("text"))
    small = joins.side_join(df, side, ["k"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.side_join(df, side, ["k"])
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert small.exceptAll(large.select(small.columns)).isEmpty() and large.count() == 300
        split = scan(df, ["k"], ["ts", "seq"], target_rows=20, **SCANS)
        plain = scan(df, ["k"], ["ts", "seq"], **SCANS)
        assert split.exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
