"""A message log laid out once for many uses: bucketed by recording, sorted by time, partitioned by day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from robolog.contracts import NS
from robolog.operators.align import CLOCK, latest_on_clock
from robolog.operators.layout import Layout

DAY_NS = 86_400 * NS
BUCKETS = 200


def write_store(
    log: DataFrame, name: str, path: str, *, bag: str = "bag_id", ts: str = "ts_ns", seq: str = "seq", buckets: int = BUCKETS
) -> DataFrame:
    """Save a log as the table ``name`` with its files below ``path``, and give it back.

    The rows go through one exchange on the recording; a task then writes one sorted file for each day it
    has. What works per recording later (latest-at, fills, numbering, statistics) finds its rows where it
    wants them and exchanges nothing, and a range of time reads the files of its days only.
    """
    day = F.expr(f"`{ts}` DIV {DAY_NS}")
    (
        log.withColumn("day", day)
        .repartition(buckets, bag)
        .sortWithinPartitions("day", bag, ts, seq)
        .write.mode("overwrite")
        .partitionBy("day")
        .bucketBy(buckets, bag)
        .sortBy(bag, ts, seq)
        .option("path", path)
        .saveAsTable(name)
    )
    return log.sparkSession.table(name)


def read_store(spark: SparkSession, name: str, start_ns: int | None = None, end_ns: int | None = None, ts: str = "ts_ns") -> DataFrame:
    """The log, or its rows from ``start_ns`` on and before ``end_ns``; other days' files are not read."""
    rows = spark.table(name)
    if start_ns is not None:
        rows = rows.where((F.col("day") >= start_ns // DAY_NS) & (F.col(ts) >= start_ns))
    if end_ns is not None:
        rows = rows.where((F.col("day") <= (end_ns - 1) // DAY_NS) & (F.col(ts) < end_ns))
    return rows


def asof_in_store(
    store: DataFrame,
    clock: str,
    topics: Mapping[str, str],
    *,
    bag: str = "bag_id",
    topic: str = "entity_path",
    ts: str = "ts_ns",
    seq: str = "seq",
    value: str = "value",
    layout: Layout | None = None,
    target_rows: int | None = None,
) -> DataFrame:
    """At each message of the path ``clock`` the latest value of every topic: (bag, ts, seq, one column per topic).

    The clock is part of the log, so its rows and the messages are one scan of the store and need no union:
    the window runs on the buckets as they lie. A recording too large for a task is cut as everywhere else.
    """
    known = store.where(F.col(topic).isin(clock, *topics))
    values = [F.when(F.col(topic) == path, F.col(value)).alias(out) for path, out in topics.items() if path != clock]
    own = [F.col(value).alias(out) for path, out in topics.items() if path == clock]
    rows = known.select(bag, ts, seq, (F.col(topic) == clock).cast("int").alias(CLOCK), *values, *own)
    return latest_on_clock(rows, bag, ts, seq, [c for p, c in topics.items() if p != clock], layout, target_rows)
