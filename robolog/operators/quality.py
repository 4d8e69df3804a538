"""Reports that must come out empty, and counts of what went through."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _literals(values: Sequence[str]):
    return F.array(*[F.lit(v) for v in values])


def missing_inputs(
    found: DataFrame, expected: Sequence[str], *, bag: str = "bag_id", name: str = "name"
) -> DataFrame:
    """Inputs a recording should have and does not: (bag, name). One aggregate, no join."""
    flags = found.groupBy(bag).agg(
        *[F.max(F.col(name) == e).alias(f"_{i}") for i, e in enumerate(expected)]
    )
    absent = F.array_compact(
        F.array(*[F.when(~F.coalesce(f"_{i}", F.lit(False)), F.lit(e)) for i, e in enumerate(expected)])
    )
    return flags.select(bag, F.explode(absent).alias(name))


def unknown_names(
    found: DataFrame, known: Sequence[str], *, bag: str = "bag_id", name: str = "name"
) -> DataFrame:
    """Names a recording uses that are not known: (bag, name)."""
    return found.where(~F.col(name).isin(*known)).select(bag, name).distinct()


def name_differences(
    found: DataFrame, known: Sequence[str], *, bag: str = "bag_id", name: str = "name"
) -> DataFrame:
    """Missing and unknown names of each recording."""
    missing = missing_inputs(found, known, bag=bag, name=name).withColumn("problem", F.lit("missing"))
    unknown = unknown_names(found, known, bag=bag, name=name).withColumn("problem", F.lit("unknown"))
    return missing.unionByName(unknown)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not have."""
    return left.subtract(right)


def all_null_topics(
    df: DataFrame, *, bag: str = "bag_id", topic: str = "entity_path", value: str = "value"
) -> DataFrame:
    """Topics of a recording that hold rows but no value."""
    return (
        df.groupBy(bag, topic)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("_values"))
        .where(F.col("_values") == 0)
        .drop("_values")
    )


def stream_length_mismatch(
    frames: DataFrame, cameras: Sequence[str], *, bag: str = "bag_id", camera: str = "camera"
) -> DataFrame:
    """Recordings whose camera streams differ in length, with the shortest and longest.

    A camera without any frame counts as length 0.
    """
    lengths = frames.where(F.col(camera).isin(*cameras)).groupBy(bag).agg(
        *[F.count_if(F.col(camera) == c).alias(f"_{i}") for i, c in enumerate(cameras)]
    )
    names = [f"_{i}" for i in range(len(cameras))]
    return lengths.select(
        bag, F.least(*names).alias("shortest"), F.greatest(*names).alias("longest")
    ).where(F.col("shortest") != F.col("longest"))


def run_report(bags: DataFrame, ok: str = "ok") -> DataFrame:
    """Number of recordings that went through and that were rejected."""
    return bags.agg(*[c.alias(name) for name, c in report_metrics(ok).items()])


def report_metrics(ok: str = "ok") -> dict[str, Column]:
    """What ``run_report`` counts, as aggregates that can be observed while the recordings are written."""
    passed = F.coalesce(F.col(ok), F.lit(False))
    return {"n_ok": F.count_if(passed), "n_failed": F.count_if(~passed)}


def require(report: DataFrame | Mapping[str, int], strict: bool) -> None:
    """Apply the error policy: no success is always an error, a failure is one if strict. The report may be counted already."""
    counts = report.first().asDict() if isinstance(report, DataFrame) else report
    if counts["n_ok"] == 0:
        raise RuntimeError("no recording went through")
    if strict and counts["n_failed"]:
        raise RuntimeError(f"{counts['n_failed']} recordings were rejected")
