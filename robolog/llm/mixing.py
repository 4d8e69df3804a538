"""Mixing sources to target weights: budgets down a domain-language-source tree, then seeded token prefixes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from robolog.operators.joins import side_join

LEVELS = ["domain", "lang", "source"]
#: Hexadecimal digits of the seeded order that form a block: 4096 blocks for each leaf.
BLOCK_DIGITS = 3


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """Integer weight of a node; nodes that are not listed weigh 1."""
    pairs = [F.lit(x) for item in weights.items() for x in item]
    found = F.element_at(F.create_map(*pairs), F.col(level)) if pairs else F.lit(None)
    return F.coalesce(found.cast("bigint"), F.lit(1).cast("bigint"))


def _fill(nodes: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Share each parent's ``budget`` among its children by ``w``, none above its ``cap``: column ``share``.

    Children are taken by rising cap per weight. A child whose cap is at most its part of what is left
    is filled, and what it lacks stays with its siblings; the others divide the rest by weight, rounded
    so that the parts add up. All in whole numbers.
    """
    whole = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = whole.orderBy(F.col("cap") / F.col("w"), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("bigint")
    rest = F.col("budget") - F.coalesce(F.sum("cap").over(before), zero)
    rest_w = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), zero)
    full = nodes.withColumn("full", F.col("cap") * rest_w <= F.col("w") * rest)
    open_w = F.when(~F.col("full"), F.col("w")).otherwise(zero)
    parts = full.select(
        "*",
        (F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(zero)).over(whole)).alias("left"),
        F.sum(open_w).over(whole).alias("all_w"),
        F.sum(open_w).over(upto).alias("upto_w"),
    )
    part = F.expr("(left * upto_w) div all_w - (left * (upto_w - w)) div all_w")
    return parts.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.least(part, F.col("cap")))).drop("full", "left", "all_w", "upto_w")


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: int | None, budget_percent: int, max_epochs: int) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with their token budget.

    The total is ``budget`` tokens, or ``budget_percent`` of all there are. It is shared among domains,
    each domain's among its languages, each language's among its sources. A node can take at most the
    tokens of its leaves times ``max_epochs``, so a shortage stays with siblings as long as they can take
    it, and only then goes to the parent's siblings.
    """
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = F.lit(budget).cast("bigint") if budget is not None else F.expr(f"(sum(tokens) * {int(budget_percent)}) div 100")
    given = caps.agg(F.least(total if budget is None else F.max(total), F.sum("cap")).alias("budget"))
    up = [given.withColumn("all", F.lit(1))]
    for depth in range(3):
        parents, child = LEVELS[:depth], LEVELS[depth]
        nodes = caps.groupBy(*parents, child).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(child, weights.get(child, {})))
        if depth:
            nodes = nodes.join(up[-1], parents)
        else:
            nodes = nodes.withColumn("all", F.lit(1)).join(up[-1], "all").drop("all")
        up.append(_fill(nodes, parents, child).select(*parents, child, F.col("share").alias("budget")))
    return leaves.join(up[-1], LEVELS)


def mix(
    docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], *, budget: int | None = None,
    budget_percent: int = 100, max_epochs: int = 4, seed: int = 0, key: str = "doc_id", text: str = "text",
    bytes_per_token: int = 4, keep: list[str] | None = None, plan_columns: bool = True,
) -> DataFrame:
    """The chosen rows, once for each epoch they are in: the columns ``keep`` (default: all of ``docs``), then
    mix_domain, mix_lang, mix_source, mix_tokens, mix_epoch (unless ``plan_columns`` is false).

    ``domain`` names a row's domain; the leaves are (domain, lang, source), a null counts as ``unknown``.
    ``weights`` gives whole numbers for the nodes of each level, 1 where a node is not listed. A document
    has its UTF-8 bytes over ``bytes_per_token`` tokens, rounded up. A leaf's budget covers whole epochs of
    its rows, then the prefix of one more epoch: the rows before which, in that epoch's seeded order, fewer
    tokens stand than remain. Rows of equal id are ordered by their tokens and content; repeated rows count
    each by itself. An empty table gives an empty result.

    The running sum never runs over a whole leaf: tokens are first added up by block of the seeded order
    (its first digits, hence equal parts of a leaf), the blocks are summed up, and rows are ordered within
    their block only. The plan has a row for each leaf; it is written once and broadcast if its measured
    size is small, else a shuffle join runs.
    """
    named = lambda c: F.coalesce(c.cast("string"), F.lit("unknown"))
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint")
    kept = docs.columns if keep is None else keep
    leaf = [named(domain).alias("mix_domain"), named(F.col("lang")).alias("mix_lang"), named(F.col("source")).alias("mix_source")]
    rows = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.col(key).alias("mix_key"), *leaf,
        F.ceil(size / F.lit(bytes_per_token)).alias("mix_tokens"),
        F.xxhash64(text).alias("mix_tie"),
    )
    to = dict(zip(LEVELS, ["mix_domain", "mix_lang", "mix_source"], strict=True))
    leaves = rows.groupBy(*[F.col(to[x]).alias(x) for x in LEVELS]).agg(F.sum("mix_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, weights, budget, budget_percent, max_epochs).select(
        *[F.col(x).alias(to[x]) for x in LEVELS],
        F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0L END").alias("epochs"),
        F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0L END").alias("rest"),
    )
    by_leaf = list(to.values())
    order_key = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("epochs") + 1).cast("string"), F.coalesce(F.col("mix_key").cast("string"), F.lit(""))))
    placed = side_join(rows, plan, by_leaf, "inner").withColumn("mix_order", order_key).withColumn("mix_block", F.substring("mix_order", 1, BLOCK_DIGITS))
    blocks = placed.groupBy(*by_leaf, "mix_block").agg(F.sum("mix_tokens").alias("block_tokens"))
    ahead = Window.partitionBy(*by_leaf).orderBy("mix_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*by_leaf, "mix_block", F.coalesce(F.sum("block_tokens").over(ahead), F.lit(0).cast("bigint")).alias("block_before"))
    within = Window.partitionBy(*by_leaf, "mix_block").orderBy("mix_order", "mix_key", "mix_tokens", "mix_tie").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("block_before") + F.coalesce(F.sum("mix_tokens").over(within), F.lit(0).cast("bigint"))
    chosen = placed.join(blocks, [*by_leaf, "mix_block"]).withColumn("mix_before", before)
    times = F.col("epochs") + F.when(F.col("mix_before") < F.col("rest"), 1).otherwise(0)
    chosen = chosen.withColumn("times", times).where("times > 0")
    out = chosen.withColumn("mix_epoch", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))
    added = [*by_leaf, "mix_tokens", "mix_epoch"] if plan_columns else []
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], *added)
