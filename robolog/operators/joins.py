"""Joins against side tables whose size is checked before they are broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from robolog.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_BYTES = 16

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)


def _cell_bytes(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, _FIXED):
        return F.lit(FIXED_BYTES)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, _FIXED):
        size = F.size(value) * 8
    else:
        size = F.octet_length(F.to_json(F.struct(value)))
    return F.coalesce(F.greatest(size, F.lit(0)), F.lit(0)) + FIXED_BYTES


def table_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table that has been written before."""
    width = reduce(lambda a, b: a + b, [_cell_bytes(F.col(f.name), f.dataType) for f in df.schema])
    found = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes")
    ).first()
    return found.n, found.bytes


def side_join(
    df: DataFrame,
    side: DataFrame,
    on: list[str],
    how: str = "left",
    rows: int | None = None,
    null_safe: bool = False,
    size: int | None = None,
) -> DataFrame:
    """Join ``df`` to a per-key side table without moving ``df`` when that is safe.

    ``size`` is its size in bytes, if the caller has measured it; ``rows`` is a known bound on
    its rows, enough if all its columns have a fixed size. Else the side is computed once
    (written to the shared folder) and measured, the texts by their actual length. Up to ``BROADCAST_BYTES`` it is broadcast, so a hot key in ``df`` stays
    spread over its tasks. Above that the shuffle join runs, where adaptive execution
    splits skewed partitions of ``df``.
    """
    least = (rows or 0) * FIXED_BYTES * len(side.columns)
    fixed = all(isinstance(f.dataType, _FIXED) for f in side.schema)
    if size is None and rows is not None and (fixed or least > BROADCAST_BYTES):
        size = least
    if size is None:
        side = materialize(side)
        _, size = table_size(side)
    if null_safe:
        names = {c: f"_side_{c}" for c in on}
        side = side.select(*[F.col(c).alias(names.get(c, c)) for c in side.columns])
        same: Column = reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(names[c])) for c in on]
        )
        side = F.broadcast(side) if size <= BROADCAST_BYTES else side
        return df.join(side, same, how).drop(*names.values())
    return df.join(F.broadcast(side) if size <= BROADCAST_BYTES else side, on, how)
