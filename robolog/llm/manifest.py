"""Merkle manifest of a table: a tree of digests per group of rows, one over the groups, and a proof for every row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from robolog.llm.common import ascii_lower
from robolog.operators.joins import side_join
from robolog.operators.scan import numbered
from robolog.session import materialize, write_once

FANOUT = 8
#: Rows numbered by one task.
RANGE_ROWS = 500_000


def _field(value: Column) -> Column:
    """``-`` for null, else the value's byte count, a colon and its bytes."""
    content = value.cast("string").cast("binary")
    size = F.concat(F.octet_length(content).cast("string"), F.lit(":")).cast("binary")
    return F.coalesce(F.concat(size, content), F.lit(b"-"))


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 of a row's fields in lowercase hex: different rows never give the same bytes to hash."""
    return F.sha2(F.concat(*map(_field, fields)), 256)


def place_leaves(leaves: DataFrame, key: str) -> DataFrame:
    """``idx``, the place of a leaf in its tree by ``key`` (null first; ties by digest), and ``n``, the tree's leaves.

    Rows are range partitioned over all trees, so a tree of any size is numbered by many tasks: each has
    its own rows in order, and adds the rows that its trees have in earlier ranges. ``leaves`` is a table
    that is written already.
    """
    parts = max(leaves.sparkSession.sparkContext.defaultParallelism, leaves.count() // RANGE_ROWS + 1)
    # The last column splits rows that are the same throughout; they may take any order.
    order = ["tree", key, "leaf", "__row"]
    ranged = leaves.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = write_once(ranged.withColumn("__row", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__row", 33)))
    held = rows.groupBy("tree", "__part").agg(F.min("__row").alias("first"), F.count("*").alias("held"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "tree", "__part", (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("first")).alias("__shift"), F.sum("held").over(tree).alias("n"))
    return side_join(rows, starts, ["tree", "__part"], "inner").withColumn("idx", F.col("__row") + F.col("__shift")).drop("__row", "__part", "__shift")


def gather_runs(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row per run of siblings: tree, run, n (parents in the tree), kids (digests in order).

    The first node of each run looks its siblings up by their computed places: its place XOR 1 in a binary
    tree, its place plus each slot otherwise.
    """
    heads = nodes.where(F.col("idx") % fanout == 0)
    if fanout == 2:
        slots = F.array(F.lit(1).cast("bigint"))
        sibling = F.col("idx").bitwiseXOR(F.lit(1))
    else:
        slots = F.sequence(F.lit(1).cast("bigint"), F.lit(fanout - 1).cast("bigint"))
        sibling = F.col("idx") + F.col("slot")
    asked = heads.select(
        "tree", "idx", "n", "h", F.explode_outer(F.filter(slots, lambda s: F.col("idx") + s < F.col("n"))).alias("slot")
    ).withColumn("sibling", sibling)
    answers = nodes.select(F.col("tree").alias("__tree"), F.col("idx").alias("sibling_idx"), F.col("h").alias("sibling_h"))
    met = asked.join(answers, (F.col("tree") == F.col("__tree")) & (F.col("sibling") == F.col("sibling_idx")), "left")
    rest = F.array_sort(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "sibling_h"))))
    return met.groupBy("tree", F.expr(f"idx DIV {fanout}").alias("run"), F.ceil(F.col("n") / fanout).alias("n")).agg(
        F.concat(F.array(F.first("h")), F.transform(rest, lambda x: x["sibling_h"])).alias("kids"))


@dataclass(frozen=True)
class Forest:
    """Runs of siblings by level, lowest first, and each tree's top: tree, root."""

    levels: list[DataFrame]
    tops: DataFrame
    fanout: int


def build_forest(nodes: DataFrame, fanout: int = FANOUT) -> Forest:
    """All levels over nodes (tree, idx, n, h); a tree of one node is its own top. One job a level, each a fanout-th of the last."""
    highest = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], nodes.where("n = 1")
    while highest > 1:
        runs = materialize(gather_runs(nodes.where("n > 1"), fanout))
        levels.append(runs)
        nodes = runs.select("tree", F.col("run").alias("idx"), "n", F.sha2(F.concat_ws("", "kids"), 256).alias("h"))
        tops = tops.unionByName(nodes.where("n = 1"))
        highest = -(-highest // fanout)
    return Forest(levels, materialize(tops.select("tree", F.col("h").alias("root"))), fanout)


def _beside(kids: Column, slot: Column) -> Column:
    """What stands left and right of a node in its run."""
    return F.struct(
        F.concat_ws("", F.slice(kids, F.lit(1), slot)).alias("left"),
        F.concat_ws("", F.slice(kids, slot + 2, F.greatest(F.size(kids) - slot - 1, F.lit(0)))).alias("right"))


def paths(forest: Forest, above: DataFrame) -> DataFrame:
    """tree, run, kids, root, path: for every lowest run what stands beside its parent, its grandparent and so on.

    ``above`` (tree, root, path) has what follows beyond each tree's top. Paths go down from the tops, one
    join a level, so a run's path is sent once for all its nodes.
    """
    found = None
    for runs in reversed(forest.levels):
        begun = runs.where("n = 1").join(above, "tree")
        if found is None:
            found = begun
            continue
        parents = found.select("tree", F.posexplode("kids").alias("slot", "kid"), "run", "kids", "root", "path").select(
            "tree", (F.col("run") * forest.fanout + F.col("slot")).alias("run"), "root",
            F.concat(F.array(_beside(F.col("kids"), F.col("slot"))), "path").alias("path"))
        found = begun.unionByName(runs.where("n > 1").join(parents, ["tree", "run"]).select(*begun.columns))
    return found


def with_paths(nodes: DataFrame, forest: Forest, above: DataFrame) -> DataFrame:
    """Every node with its tree's root and its own path, through the tree and beyond."""
    lone = nodes.where("n = 1").join(above, "tree")
    runs = paths(forest, above)
    if runs is None:
        return lone
    slot = (F.col("idx") % forest.fanout).cast("int")
    inner = nodes.where("n > 1").withColumn("run", F.expr(f"idx DIV {forest.fanout}")).join(
        runs.select("tree", "run", "kids", "root", F.col("path").alias("rest")), ["tree", "run"])
    inner = inner.withColumn("path", F.concat(F.array(_beside(F.col("kids"), slot)), "rest"))
    return lone.unionByName(inner.select(*lone.columns))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings on its path."""
    return F.aggregate(path, leaf, lambda h, beside: F.sha2(F.concat(beside["left"], h, beside["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, level by level from left to right; of nothing where there are none."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda x: F.concat(x["left"], x["right"]))), 256)


NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


def dataset_manifest(leaves: DataFrame, key: str, fanout: int = FANOUT) -> DataFrame:
    """All columns of ``leaves`` (at least tree, ``key``, leaf) with subroot, root and path.

    Each tree's leaves ascend by ``key``; runs of ``fanout`` give their parent until one node is left, the
    subroot. Subroots in the order of their trees give the root in the same way. Keys may be null (first)
    and repeat (by digest); a tree may have one leaf; without leaves there is no root and no row.
    """
    placed = write_once(place_leaves(leaves, key).withColumn("h", F.col("leaf")))
    trees = build_forest(placed.select("tree", "idx", "n", "h"), fanout)
    tops = numbered(trees.tops, "tree", "idx")
    count = trees.tops.count()
    subroots = tops.select(F.lit("").alias("tree"), "idx", F.lit(count).cast("bigint").alias("n"), F.col("root").alias("h"), F.col("tree").alias("of"))
    crown = build_forest(subroots.select("tree", "idx", "n", "h"), fanout)
    above = materialize(
        with_paths(subroots, crown, crown.tops.withColumn("path", F.expr(NO_PATH))).select(
            F.col("of").alias("tree"), F.struct(F.col("h").alias("subroot"), "root").alias("root"), "path"))
    found = with_paths(placed, trees, above)
    return found.select(*leaves.columns, F.col("root")["subroot"].alias("subroot"), F.col("root")["root"].alias("root"), "path")


def document_manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", text: str = "text", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    fanout: int = FANOUT,
) -> DataFrame:
    """``key``, leaf, changed_leaf, subroot, root, path for every row: its digest, its place under the root, and a changed copy's digest.

    The changed copy has A-Z of the text lowered where the CRC-32 of the key's decimal form is divisible by
    3 (never for a null key); other rows keep their digest. Null fields are ``-`` in the digest, so they
    differ from empty ones. A null group is a tree of its own, before all others. Texts are read once and
    only digests are moved. Repeated rows are leaves of their own; other columns are ignored.
    """
    changes = F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0
    lowered = [F.when(F.col(text).isNotNull(), ascii_lower(text)) if f == text else F.col(f) for f in fields]
    # Null first, then by the bytes of the group's name.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(
        F.col(key).alias("key"), tree.alias("tree"), row_digest([F.col(f) for f in fields]).alias("leaf"),
        F.when(changes, row_digest(lowered)).alias("changed_leaf"),
    ).withColumn("changed_leaf", F.coalesce("changed_leaf", "leaf"))
    return dataset_manifest(write_once(leaves), "key", fanout).drop("tree").withColumnRenamed("key", key)
