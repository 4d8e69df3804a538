"""Recording folders: listing, required files and clock anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from robolog.contracts import BAG_PREFIX, CAMERAS
from robolog.functions.times import anchor_from_text, bag_timestamp
from robolog.operators.quality import missing_inputs

# Names inside a recording folder.
BAG_PATTERN = f"/({BAG_PREFIX}[^/]+)/"
TILED_VIDEO = "/video/cameras.mp4"
MESSAGE_LOG = "data/data_0.mcap"
ANCHOR_FILE = "video/cameras_first_frame.yaml"
CAMERA_FILES = [f"video/{c}.mp4" for c in CAMERAS]


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Files below ``root``: (path, length, modificationTime). File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select("path", "length", "modificationTime")


def in_bags(files: DataFrame) -> DataFrame:
    """Files that lie in a recording folder, with the recording and the path inside it."""
    bag = F.regexp_extract("path", BAG_PATTERN, 1)
    inside = F.regexp_extract("path", BAG_PATTERN + "(.*)$", 2)
    return files.withColumn("bag_id", bag).withColumn("name", inside).where(F.col("bag_id") != "")


def bag_catalog(files: DataFrame) -> DataFrame:
    """One row per recording: timestamp text, files, bytes, tiled videos."""
    return (
        in_bags(files)
        .groupBy("bag_id")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("bytes"),
            F.count_if(F.col("path").endswith(TILED_VIDEO)).alias("n_tiled_videos"),
        )
        .withColumn("bag_ts", bag_timestamp(F.col("bag_id")))
    )


def tiled_videos(files: DataFrame) -> DataFrame:
    return files.where(F.col("path").endswith(TILED_VIDEO)).orderBy("path")


def missing_files(files: DataFrame) -> DataFrame:
    """Required files each recording lacks: (bag_id, name)."""
    return missing_inputs(in_bags(files), [MESSAGE_LOG, ANCHOR_FILE, *CAMERA_FILES])


def earliest_bag(bags: DataFrame, stamp: str = "bag_ts") -> DataFrame:
    """The earliest timestamp text, which names the output."""
    return bags.agg(F.min(stamp).alias(stamp))


def read_anchors(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """Clock anchors of all recordings below ``root``; a file without one fails the query, or
    gives null if not ``strict``."""
    texts = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", ANCHOR_FILE.split("/")[-1])
        .text(root, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    return clock_anchor(in_bags(texts), text="value", strict=strict)


def clock_anchor(
    texts: DataFrame, *, bag: str = "bag_id", text: str = "text", strict: bool = False
) -> DataFrame:
    """First-frame epoch per recording from the text of its anchor file."""
    epoch = anchor_from_text(F.col(text))
    if strict:
        problem = F.concat(F.lit("no first_frame_time.epoch_ns for "), F.col(bag).cast("string"))
        epoch = F.coalesce(epoch, F.raise_error(problem).cast("bigint"))
    return texts.select(bag, epoch.alias("first_frame_epoch_ns"))
