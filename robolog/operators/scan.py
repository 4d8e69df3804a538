"""Ordered scans per key: row numbers, running sums, lag, and fills in both directions.

Where no key is over-full a scan is a single window: one exchange on the key, one sort.
For a split layout the same window runs inside each cell, one small summary row per cell is
scanned over the cells of its key, and the summary is joined back on (key, cell). Keys may be
null, so the window and the join both use stand-ins that never are: the join then finds the
rows where the window has put them, and they are shuffled and sorted once. Both forms give
the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from robolog.operators.joins import side_join, table_size
from robolog.operators.layout import HOT, TARGET_ROWS, Layout, measure
from robolog.session import materialize


# What a window over a whole small table may hold.
ONE_TASK_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Scan:
    """One output column of an ordered scan over ``column``."""

    kind: str  # row_number | sum | last | next | lag
    column: str | None = None


def row_number() -> Scan:
    """Position in the key, starting at 1."""
    return Scan("row_number")


def running_sum(column: str) -> Scan:
    """Sum up to and including the row."""
    return Scan("sum", column)


def last_value(column: str) -> Scan:
    """Latest non-null value at or before the row."""
    return Scan("last", column)


def next_value(column: str) -> Scan:
    """Earliest non-null value at or after the row."""
    return Scan("next", column)


def lag(column: str) -> Scan:
    """Value of the row before (null on the first row)."""
    return Scan("lag", column)


def _directions(keys: list[str], order: Sequence[str]):
    forward = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
    backward = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return forward, backward


def _window(spec: Scan, keys: list[str], order: Sequence[str]) -> Column:
    forward, backward = _directions(keys, order)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if spec.kind == "row_number":
        return F.row_number().over(forward).cast("bigint")
    if spec.kind == "sum":
        return F.sum(spec.column).over(forward.rowsBetween(*so_far))
    if spec.kind == "last":
        return F.last(spec.column, ignorenulls=True).over(forward.rowsBetween(*so_far))
    if spec.kind == "next":
        # Reading backwards keeps the frame growing by one row; a frame that ends at
        # the last row would be evaluated again for every row.
        return F.last(spec.column, ignorenulls=True).over(backward.rowsBetween(*so_far))
    if spec.kind == "lag":
        return F.lag(spec.column).over(forward)
    raise ValueError(f"unknown scan {spec.kind}")


def _summary(spec: Scan, order: Sequence[str]) -> Column:
    position = F.struct(*order)
    value = F.col(spec.column) if spec.column else None
    if spec.kind == "row_number":
        return F.count(F.lit(1))
    if spec.kind == "sum":
        return F.sum(value)
    if spec.kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), position))
    if spec.kind == "next":
        return F.min_by(value, F.when(value.isNotNull(), position))
    return F.max_by(F.struct(value.alias("v")), position)  # lag keeps nulls


def _carry(spec: Scan, name: str, keys: list[str], cells: list[str]) -> Column:
    """What a cell inherits from the cells before it (after it, for ``next``)."""
    forward, backward = _directions(keys, cells)
    earlier = (Window.unboundedPreceding, -1)
    if spec.kind in ("row_number", "sum"):
        return F.sum(name).over(forward.rowsBetween(*earlier))
    if spec.kind == "last":
        return F.last(name, ignorenulls=True).over(forward.rowsBetween(*earlier))
    if spec.kind == "next":
        return F.last(name, ignorenulls=True).over(backward.rowsBetween(*earlier))
    return F.lag(name).over(forward)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    layout: Layout | None = None,
    target_rows: int | None = None,
    **outputs: Scan,
) -> DataFrame:
    """Add one column per entry of ``outputs``, scanned per key in ``order``.

    ``order`` must be integer columns and should be total within a key, else ties are
    unstable. ``layout`` may be measured once and shared by scans over the same keys and
    order; left out, it is measured here.
    """
    keys, order = list(keys), list(order)
    if layout is None:
        layout = measure(df, keys, order, target_rows)
    if not layout.split:
        return df.select(
            "*", *[_window(spec, keys, order).alias(name) for name, spec in outputs.items()]
        )

    tagged = layout.tag(df)
    stand_ins = {}
    for i, key in enumerate(keys):
        absent = F.lit("" if isinstance(df.schema[key].dataType, T.StringType) else 0).cast(df.schema[key].dataType)
        stand_ins |= {f"_k{i}": F.coalesce(key, absent), f"_n{i}": F.col(key).isNull()}
    tagged = tagged.withColumns(stand_ins)
    keys = list(stand_ins)
    cell_keys = [*keys, *layout.cells]
    local = tagged.select(
        "*", *[_window(spec, cell_keys, order).alias(name) for name, spec in outputs.items()]
    )
    if any(spec.kind == "lag" for spec in outputs.values()):
        forward, _ = _directions(cell_keys, order)
        local = local.withColumn("_first", F.row_number().over(forward) == 1)

    names = {name: f"_sum_{name}" for name in outputs}
    carried = {name: f"_carry_{name}" for name in outputs}
    summary = (
        tagged.where(HOT)
        .groupBy(*cell_keys)
        .agg(*[_summary(spec, order).alias(names[name]) for name, spec in outputs.items()])
    )
    carry = summary.select(
        *cell_keys,
        *[_carry(spec, names[name], keys, layout.cells).alias(carried[name]) for name, spec in outputs.items()],
    )
    joined = side_join(local, carry, cell_keys, "left", rows=layout.n_cells)
    for name, spec in outputs.items():
        joined = joined.withColumn(name, _combine(spec, F.col(name), F.col(carried[name])))
    return joined.select(*df.columns, *outputs)


def _combine(spec: Scan, local: Column, carry: Column) -> Column:
    if spec.kind == "row_number":
        return local + F.coalesce(carry, F.lit(0))
    if spec.kind == "sum":
        # Null only while nothing has been summed yet, as a window would give.
        return F.when(local.isNull(), carry).otherwise(local + F.coalesce(carry, F.lit(0)))
    if spec.kind == "lag":
        return F.when(F.col("_first"), carry["v"]).otherwise(local)
    return F.coalesce(local, carry)


def numbered(
    df: DataFrame, order: str, name: str, *, known: tuple[int, int] | None = None, **sums: str
) -> DataFrame:
    """Number the rows of a small table 0.. by ``order``, with running sums before each row.

    For tables with one row per recording, segment or task. ``sums`` maps an output name
    to the column summed over all earlier rows. While the table fits one task it is one
    window. A larger one is range partitioned, written to the shared folder (so that the
    partition number is fixed), and numbered per partition with carried totals. ``order``
    may be of any sortable type. ``known`` gives rows and bytes of a table that is written
    already.
    """
    small = df if known else materialize(df)
    rows, size = known or table_size(small)
    before = (Window.unboundedPreceding, -1)
    if rows <= TARGET_ROWS and size <= ONE_TASK_BYTES:
        whole = Window.orderBy(order)
        return small.select(
            "*",
            (F.row_number().over(whole).cast("bigint") - 1).alias(name),
            *[
                F.coalesce(F.sum(c).over(whole.rowsBetween(*before)), F.lit(0)).alias(out)
                for out, c in sums.items()
            ],
        )
    parts = 2 * max(rows // TARGET_ROWS, size // ONE_TASK_BYTES) + 2
    return numbered_by_range(small, order, name, parts, sums)


def numbered_by_range(
    df: DataFrame, order: str, name: str, partitions: int, sums: dict[str, str]
) -> DataFrame:
    """The partitioned form of ``numbered``."""
    part = "_part"
    before = (Window.unboundedPreceding, -1)
    ranged = materialize(
        df.repartitionByRange(partitions, order).withColumn(part, F.spark_partition_id())
    )
    inside = Window.partitionBy(part).orderBy(order)
    local = ranged.select(
        "*",
        (F.row_number().over(inside).cast("bigint") - 1).alias(name),
        *[
            F.coalesce(F.sum(c).over(inside.rowsBetween(*before)), F.lit(0)).alias(out)
            for out, c in sums.items()
        ],
    )
    totals = ranged.groupBy(part).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{out}") for out, c in sums.items()]
    )
    cells = Window.orderBy(part).rowsBetween(*before)
    offsets = totals.select(
        part,
        F.coalesce(F.sum("_n").over(cells), F.lit(0)).alias("_n"),
        *[F.coalesce(F.sum(f"_t_{out}").over(cells), F.lit(0)).alias(f"_t_{out}") for out in sums],
    )
    joined = side_join(local, offsets, [part], "left", rows=partitions)
    for out in sums:
        joined = joined.withColumn(out, F.col(out) + F.col(f"_t_{out}"))
    return joined.withColumn(name, F.col(name) + F.col("_n")).drop(
        part, "_n", *[f"_t_{out}" for out in sums]
    )
