"""Measure how rows are spread over keys and split the keys that hold too many.

Ordered operators work per recording. Most recordings fit one task, so the plain plan is
a single window per recording. One recording may hold a large share of all rows, though.
``measure`` counts rows per key (partial aggregation, nothing but counts is moved). Keys
above ``target_rows`` are cut into cells along the order columns, and cells that are still
too full are cut again, so bursts of messages in a short time end up in many cells as
well. Cells of a key are ordered, which lets the scans in ``scan.py`` work inside each
cell and carry a small summary from cell to cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, functions as F

from robolog.operators.joins import side_join
from robolog.session import materialize

TARGET_ROWS = 2_000_000
# For rows that carry an encoded frame: at 20 kB a packet this is 1 GB per task.
BLOB_ROWS = 50_000
HOT = "_hot"
# Cells per cut for each ``target_rows`` rows in the cell. Rows are rarely even in time, so
# some cells of a cut are over-full; only these are cut again.
FAN_OUT = 8


@dataclass(frozen=True)
class Level:
    """One round of cuts: a row per over-full cell with the column and width to cut by."""

    table: DataFrame
    rows: int


@dataclass(frozen=True)
class Layout:
    keys: tuple[str, ...]
    order: tuple[str, ...]
    n_keys: int = 0
    n_rows: int = 0
    max_rows: int = 0
    n_cells: int = 0
    levels: tuple[Level, ...] = ()

    @property
    def split(self) -> bool:
        return bool(self.levels)

    @property
    def cells(self) -> list[str]:
        """The columns that name a cell; their order is the order of the rows."""
        return [f"_c{depth}" for depth in range(len(self.levels))]

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the cell columns and whether the key is split at all."""
        out = df
        for depth, level in enumerate(self.levels):
            out = _descend(out, level, self.keys, self.order, depth, "left")
        return out


def _descend(
    df: DataFrame, level: Level, keys: tuple[str, ...], order: tuple[str, ...], depth: int, how: str
) -> DataFrame:
    """Number the cell of each row within its parent cell; 0 where the parent is not cut."""
    parents = [f"_c{i}" for i in range(depth)]
    joined = side_join(df, level.table, [*keys, *parents], how, rows=level.rows, null_safe=True)
    # Integer division: a double quotient loses nanoseconds beyond 2**53.
    cuts = " ".join(f"WHEN {i} THEN (CAST(`{c}` AS BIGINT) - _lo) DIV _width" for i, c in enumerate(order))
    cell = F.expr(f"CASE WHEN _width IS NULL THEN 0L ELSE coalesce(CASE _by {cuts} END, -1L) END")
    out = joined.withColumn(f"_c{depth}", cell)
    if depth == 0:
        out = out.withColumn(HOT, F.col("_width").isNotNull())
    return out.drop("_by", "_lo", "_width")


def _stats(df: DataFrame, group: list[str], order: tuple[str, ...]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, name in enumerate(order):
        aggs += [
            F.min(F.col(name).cast("bigint")).alias(f"_min{i}"),
            F.max(F.col(name).cast("bigint")).alias(f"_max{i}"),
        ]
    return df.groupBy(*group).agg(*aggs)


def _cuts(stats: DataFrame, group: list[str], order: tuple[str, ...], target: int) -> DataFrame:
    """For every over-full cell: the first order column that varies, null if none does."""
    by = lo = hi = F.lit(None).cast("bigint")
    for i in reversed(range(len(order))):
        varies = F.col(f"_max{i}") > F.col(f"_min{i}")
        by = F.when(varies, F.lit(i)).otherwise(by)
        lo = F.when(varies, F.col(f"_min{i}")).otherwise(lo)
        hi = F.when(varies, F.col(f"_max{i}")).otherwise(hi)
    parts = F.ceil(F.lit(FAN_OUT) * F.col("_n") / F.lit(target))
    return (
        stats.where(F.col("_n") > target)
        .select(*group, by.alias("_by"), lo.alias("_lo"), hi.alias("_hi"), parts.alias("_parts"), "_n")
        .withColumn("_width", F.expr("(_hi - _lo) DIV _parts + 1"))
        # No more cells than rows, nor than values to tell apart.
        .withColumn("_cells", F.expr("least(_n, (_hi - _lo) DIV _width + 1)"))
    )


def key_counts(df: DataFrame, keys: list[str] | tuple[str, ...]) -> Row:
    """Number of keys, of rows, and rows of the fullest key: one aggregate job."""
    return totals(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "_n")


def totals(counts: DataFrame, rows: str) -> Row:
    """The same figures from a table that has one row per key."""
    return counts.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max(rows), F.lit(0)).alias("fullest"),
    ).first()


def measure(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    order: list[str] | tuple[str, ...],
    target_rows: int | None = None,
    total: Row | None = None,
) -> Layout:
    """Count rows per key and, only if some key is over ``target_rows``, plan its cells.

    One aggregate job in the usual case, none if the counts are known (``total``). ``order``
    columns are integers (or booleans). Cells are cut until none is over-full; more rows than
    one task should hold that agree in all order columns are an error. Every level table has at most ``rows / target_rows`` entries, since each entry stands
    for more than ``target_rows`` rows.
    """
    target = target_rows or TARGET_ROWS
    keys, order = tuple(keys), tuple(order)
    total = total or key_counts(df, keys)
    base = dict(
        keys=keys, order=order, n_keys=total.n_keys, n_rows=total.n_rows, max_rows=total.fullest
    )
    if total.fullest <= target:
        return Layout(**base)

    tagged = df.select(*keys, *order)
    levels: list[Level] = []
    n_cells = total.n_keys
    while True:
        depth = len(levels)
        group = [*keys, *[f"_c{i}" for i in range(depth)]]
        full = materialize(_cuts(_stats(tagged, group, order), group, order, target))
        cuts = full.where(F.col("_by").isNotNull())
        found = full.agg(
            F.count("_by").alias("n"),
            F.coalesce(F.sum("_cells"), F.lit(0)).alias("cells"),
            F.max(F.when(F.col("_by").isNull(), F.col("_n"))).alias("tied"),
        ).first()
        if (found.tied or 0) > max(target, TARGET_ROWS):
            raise ValueError(
                f"{found.tied} rows of one key have equal {', '.join(order)}: they have no order to be cut by; "
                "add a column that tells them apart"
            )
        if found.n == 0:
            break
        level = Level(cuts.select(*group, "_by", "_lo", "_width"), found.n)
        levels.append(level)
        n_cells += found.cells
        # Only rows of cells that were just cut can need another cut.
        tagged = _descend(tagged, level, keys, order, depth, "inner").drop(HOT)
    return Layout(**base, n_cells=n_cells, levels=tuple(levels))
