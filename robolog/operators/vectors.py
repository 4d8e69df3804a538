"""Vector widths, feature inference and checks against a robot contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from robolog.functions.numeric import flatten_lists, float_castable


def _fixed_map(values: Mapping[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def vector_width(
    df: DataFrame,
    targets: Mapping[str, int],
    *,
    keys: Sequence[str] = ("bag_id",),
    topic: str = "entity_path",
    values: str = "values",
) -> DataFrame:
    """Export width per topic: the longest flattened row, at least 1 and at least the target."""
    longest = F.greatest(F.max(F.coalesce(F.size(values), F.lit(0))), F.lit(1))
    widths = df.groupBy(*keys, topic).agg(longest.cast("bigint").alias("inferred"))
    wanted = F.try_element_at(_fixed_map(targets), F.col(topic)) if targets else F.lit(None)
    return widths.withColumn(
        "width", F.greatest(F.col("inferred"), F.coalesce(wanted, F.col("inferred"))).cast("bigint")
    )


def column_dims(
    df: DataFrame,
    *,
    keys: Sequence[str] = ("bag_id",),
    path: str = "entity_path",
    column: str = "component",
    values: str = "values",
    order: Sequence[str] = ("ts_ns", "seq"),
) -> DataFrame:
    """Length of the first non-empty value of each column, lists flattened."""
    flat = flatten_lists(F.col(values), df.schema[values].dataType)
    sized = df.select(*keys, path, column, *order, F.col(values).alias("_value"), F.size(flat).alias("_size"))
    at = F.when(F.col("_size") > 0, F.struct(*order))
    return sized.groupBy(*keys, path, column).agg(
        F.coalesce(F.min_by("_size", at), F.lit(0)).cast("bigint").alias("dim"),
        F.min_by("_value", at).alias("sample"),
    )


def observed_dims(df: DataFrame, *, keys: Sequence[str] = ("bag_id",), path: str = "entity_path", **names) -> DataFrame:
    """Observed width per path: the sum over its columns."""
    dims = column_dims(df, keys=keys, path=path, **names)
    return dims.groupBy(*keys, path).agg(F.sum("dim").alias("dim"))


def dim_mismatch(
    df: DataFrame,
    expected: Mapping[str, int],
    *,
    keys: Sequence[str] = ("bag_id",),
    path: str = "entity_path",
    column: str = "component",
    **names,
) -> DataFrame:
    """Paths of each recording whose width breaks the contract, with a sample value.

    Absent paths count as width 0. The contract is a short literal list, so it is
    exploded per recording instead of joined.
    """
    keys = list(keys)
    dims = column_dims(
        df.where(F.col(path).isin(*expected)), keys=keys, path=path, column=column, **names
    )
    by_path = dims.groupBy(*keys, path).agg(
        F.sum("dim").alias("observed"),
        F.min_by("sample", F.when(F.col("sample").isNotNull(), F.col(column))).alias("sample"),
    )
    wanted = F.explode(_fixed_map(expected)).alias(path, "expected")
    every = df.groupBy(*keys).agg(F.count(F.lit(1))).select(*keys, wanted)
    return (
        every.join(by_path, [*keys, path], "left")
        .withColumn("observed", F.coalesce("observed", F.lit(0)))
        .withColumn("expected", F.col("expected").cast("bigint"))
        .where(F.col("observed") != F.col("expected"))
    )


def joint_dim(
    df: DataFrame,
    columns: Sequence[str],
    out: str,
    *,
    keys: Sequence[str] = ("bag_id",),
    order: Sequence[str] = ("ts_ns", "seq"),
) -> DataFrame:
    """Total width of several columns on the first row where none of them is null."""
    check_castable(df, columns)
    complete = F.lit(True)
    total = F.lit(0)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
        total = total + F.size(c)
    at = F.when(complete, F.struct(*order))
    return df.groupBy(*keys).agg(F.min_by(total, at).cast("bigint").alias(out))


def check_castable(df: DataFrame, columns: Sequence[str]) -> None:
    for c in columns:
        if not float_castable(df.schema[c].dataType):
            raise ValueError(f"column {c} of type {df.schema[c].dataType} is no float32 data")


def infer_features(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]],
    *,
    names: Mapping[str, Sequence[str]] | None = None,
    images: Mapping[str, tuple[str, str, str]] | None = None,
    use_videos: bool = True,
    keys: Sequence[str] = ("bag_id",),
    order: Sequence[str] = ("ts_ns", "seq"),
) -> DataFrame:
    """One row per recording and feature: name, dtype, shape, names, and whether it is usable.

    ``groups`` maps a vector feature to its columns; ``images`` maps a camera feature to
    its (height, width, channels) columns, read on the first frame that has them.
    """
    names, images = names or {}, images or {}
    keys = list(keys)
    texts = "array<string>"
    aggs: list[Column] = []
    for feature, columns in groups.items():
        check_castable(df, columns)
        complete, total = F.lit(True), F.lit(0)
        for c in columns:
            complete = complete & F.col(c).isNotNull()
            total = total + F.size(c)
        at = F.when(complete, F.struct(*order))
        aggs.append(F.array(F.min_by(total, at).cast("int")).alias(feature))
    for feature, columns in images.items():
        at = F.when(F.col(columns[0]).isNotNull(), F.struct(*order))
        shape = F.array(*[F.col(c).cast("int") for c in columns])
        aggs.append(F.min_by(shape, at).alias(feature))
    rows = []
    for feature in groups:
        labels = names.get(feature)
        shape = F.col(f"`{feature}`")
        fits = F.get(shape, F.lit(0)).isNotNull()
        if labels is not None:
            fits = fits & (F.get(shape, F.lit(0)) == len(labels))
        label_col = F.array(*[F.lit(x) for x in labels]) if labels else F.lit(None)
        rows.append(_feature(feature, "float32", shape, label_col.cast(texts), fits))
    for feature in images:
        shape = F.col(f"`{feature}`")
        axes = F.array(F.lit("height"), F.lit("width"), F.lit("channels"))
        kind = "video" if use_videos else "image"
        rows.append(_feature(feature, kind, shape, axes.cast(texts), shape.isNotNull()))
    return (
        df.groupBy(*keys)
        .agg(*aggs)
        .select(*keys, F.inline(F.array(*rows)))
    )


def _feature(name: str, dtype: str, shape: Column, labels: Column, fits: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(dtype).alias("dtype"),
        shape.alias("shape"),
        labels.alias("names"),
        F.coalesce(fits, F.lit(False)).alias("usable"),
    )


def agreed_features(features: DataFrame) -> DataFrame:
    """One row per feature over all recordings, with whether they agree on it."""
    return features.groupBy("name", "dtype").agg(
        F.min("shape").alias("shape"),
        F.min("names").alias("names"),
        F.count(F.lit(1)).alias("recordings"),
        (F.coalesce(F.min("shape") == F.max("shape"), F.lit(False)) & F.min("usable")).alias("agreed"),
    )
