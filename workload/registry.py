"""Registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from robolog.functions.times import normalize_time

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def register(run):
        QUERIES[name] = run
        SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a message log: recording, path, time, sequence, payload."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("bag_id"),
        F.col("event_type").alias("entity_path"),
        normalize_time(F.col("ts"), events.schema["ts"].dataType).alias("ts_ns"),
        F.col("event_id").alias("seq"),
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "props",
        "ts",
    )


# The same relation for DuckDB; further CTEs may follow.
LOG = """WITH log AS (
  SELECT user_id AS bag_id, event_type AS entity_path, epoch_us(ts) * 1000 AS ts_ns,
         event_id AS seq, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props, ts
  FROM events)"""

TOPICS = {"click": "click", "error": "error", "purchase": "purchase", "signup": "signup"}
