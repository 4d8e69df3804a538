"""Numbers of payloads whose shape is not known: JSON walked as VARIANT, without a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from robolog.functions.numeric import extract_numbers

_QUOTED = r'"(?:[^"\\]|\\.)*"'


def json_depth(text: Column) -> Column:
    """How deep lists and objects nest in a JSON text, 0 for a scalar; brackets inside strings do not count."""
    brackets = F.regexp_replace(F.regexp_replace(text, _QUOTED, ""), r"[^\[\]{}]", "")
    steps = F.transform(F.split(brackets, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(steps, start, lambda a, s: F.struct((a["now"] + s).alias("now"), F.greatest(a["most"], a["now"] + s).alias("most")))["most"]


def _node(raw: Column, value: Column) -> Column:
    """A value with its text: the text keeps the order of an object's members, the variant the types."""
    return F.struct(raw.alias("raw"), value.alias("v"), F.schema_of_variant(value).alias("kind"))


def _children(node: Column) -> Column:
    """A list's items or an object's members in written order; ``data`` stands for its whole object; a scalar is left as it is."""
    texts = F.from_json(node["raw"], "map<string,string>")
    members = F.variant_get(node["v"], "$", "map<string,variant>")
    names = F.when(F.map_contains_key(texts, "data"), F.array(F.lit("data"))).otherwise(F.map_keys(texts))
    inside = F.transform(names, lambda k: _node(F.element_at(texts, k), F.element_at(members, k)))
    pairs = F.arrays_zip(F.from_json(node["raw"], "array<string>").alias("raw"), F.variant_get(node["v"], "$", "array<variant>").alias("v"))
    items = F.transform(pairs, lambda p: _node(p["raw"], p["v"]))
    return F.when(node["kind"].startswith("OBJECT"), inside).when(node["kind"].startswith("ARRAY") & ~_plain(node), items).otherwise(F.array(node))


def _plain(node: Column) -> Column:
    """A list of numbers only, which needs no walk."""
    return node["kind"].rlike(r"^ARRAY<(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\s*\d+\))>$")


def _numbers(node: Column) -> Column:
    kind, value = node["kind"], node["v"]
    numbers = F.filter(F.try_variant_get(value, "$", "array<double>"), lambda x: x.isNotNull())
    scalar = F.array_compact(F.array(F.try_variant_get(value, "$", "double")))
    return (
        F.when(_plain(node), numbers)
        .when(kind == "STRING", extract_numbers(F.try_variant_get(value, "$", "string")))
        .when(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|BOOLEAN|DECIMAL.*)$"), scalar)
        .otherwise(F.array().cast("array<double>"))
    )


def flatten_variant(df: DataFrame, text: str, out: str, depth: int | None = None) -> DataFrame:
    """Add ``out``: the numbers of a JSON text in depth-first order, as ``ARRAY<DOUBLE>``.

    No schema is needed, and rows may differ in shape. An object with a member ``data`` stands for it alone,
    otherwise members count in the order they are written; strings give the numbers in them, booleans 0 or 1,
    nulls nothing. A text that is null or no JSON has no numbers. The walk stays inside the row: each round
    opens one level for all rows, so there are as many as the deepest text has levels. That depth is found
    by one pass over ``text`` unless it is given; a smaller one leaves deeper levels out.
    """
    if depth is None:
        depth = df.agg(F.max(json_depth(F.col(text))).alias("d")).first().d or 0
    parsed = F.try_parse_json(F.col(text))
    walk = df.withColumn("_nodes", F.when(parsed.isNotNull(), F.array(_node(F.col(text), parsed))))
    for _ in range(depth):
        walk = walk.withColumn("_nodes", F.flatten(F.transform("_nodes", _children)))
    found = F.flatten(F.transform("_nodes", _numbers))
    return walk.withColumn(out, F.coalesce(found, F.array().cast("array<double>"))).drop("_nodes")
