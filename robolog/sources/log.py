"""Reading message logs and camera frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from robolog.contracts import FRAMES, MESSAGES, TIMELINES


def read_messages(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    strict: bool = False,
    schema: T.StructType = MESSAGES,
) -> DataFrame:
    """The message log below ``path`` (folders named ``bag_id=...`` give the recording).

    A file that cannot be read fails the read. In JSON and CSV a malformed record does so
    with ``strict``; else its fields come out null and the record is kept in ``_corrupt``,
    which ``ingest_report`` counts.
    """
    reader = spark.read.option("recursiveFileLookup", "false")
    if fmt in ("json", "csv"):
        if strict:
            return reader.schema(schema).option("mode", "FAILFAST").format(fmt).load(path)
        kept = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
        return (
            reader.schema(kept)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt")
            .format(fmt)
            .load(path)
        )
    return reader.schema(schema).option("ignoreCorruptFiles", "false").format(fmt).load(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FRAMES).parquet(path)


def ingest_report(messages: DataFrame, bag: str = "bag_id") -> DataFrame:
    """Records and rejected records per recording, with an ok flag.

    A record whose recording cannot be read either counts for the null recording.
    """
    bad = F.col("_corrupt").isNotNull() if "_corrupt" in messages.columns else F.lit(False)
    return messages.groupBy(bag).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_rejected")
    ).withColumn("ok", F.col("n_rejected") == 0)


def parsed(messages: DataFrame) -> DataFrame:
    """The records that could be read."""
    return messages.where(F.col("_corrupt").isNull()).drop("_corrupt") if "_corrupt" in messages.columns else messages


def timeline_columns() -> dict[str, str]:
    """Timeline name to message column."""
    return dict(zip(TIMELINES, ["log_time_ns", "publish_time_ns", "ros_time_ns"]))


def segment_files(df: DataFrame, segment: str = "segment_id") -> DataFrame:
    """Rows tagged with the file they came from, for one-segment-per-file logs."""
    return df.withColumn(segment, F.col("_metadata.file_name"))
