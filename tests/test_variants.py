import json
import random
import re

import pytest
from pyspark.sql import functions as F

from robolog.functions.numeric import NUMBER_PATTERN
from robolog.functions.variants import flatten_variant, json_depth


def plain(value):
    if isinstance(value, dict):
        return plain(value["data"]) if "data" in value else [x for v in value.values() for x in plain(v)]
    if isinstance(value, list):
        return [x for v in value for x in plain(v)]
    if isinstance(value, str):
        return [float(t) for t in re.findall(NUMBER_PATTERN, value)]
    return [] if value is None else [float(value)]


def some_json(depth):
    kind = random.randrange(10 if depth else 6)
    if kind < 6:
        return [None, True, random.randrange(99), random.random(), "a 1 b -2.5e1", 'quo"te [3] {4} \\ 5'][kind]
    if kind < 8:
        return [some_json(depth - 1) for _ in range(random.randrange(4))]
    return {k: some_json(depth - 1) for k in random.sample(["z", "a", "data", "m 1", "x.y", "$"], random.randrange(5))}


def found(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r.n for r in flatten_variant(df, "text", "n", **options).orderBy("id").collect()]


def test_agrees_with_a_recursive_walk(spark):
    random.seed(8)
    values = [some_json(5) for _ in range(300)]
    assert found(spark, [json.dumps(v) for v in values]) == [plain(v) for v in values]


@pytest.mark.parametrize("text, want", [
    (None, []), ("", []), ("no json", []), ("[1, 2", []), ("3", [3.0]), ('"x 4"', [4.0]), ("null", []), ("[]", []), ("{}", []), ("[[], {}]", []),
    ('{"b": 1, "a": 2}', [1.0, 2.0]), ('{"data": null, "x": 1}', []), ('[1, 2.5, 1e3]', [1.0, 2.5, 1000.0]), ("[true, false]", [1.0, 0.0]),
    ('["NaN", "1d"]', [1.0]),
])
def test_edge_cases(spark, text, want):
    assert found(spark, [text]) == [want]


def test_depth_counts_brackets_outside_strings(spark):
    texts = ["1", "[]", '{"a": [[1]]}', '"[[["', '{"[": "\\"[["}', None, "[[]] [[[]]]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(json_depth(F.col("t")).alias("d"))
    assert [r.d for r in df.collect()] == [0, 1, 3, 0, 1, None, 3]


def test_no_rows_and_a_given_depth(spark):
    df = spark.createDataFrame([], "id int, text string")
    assert flatten_variant(df, "text", "n").count() == 0
    assert found(spark, ["[[1], 2]"], depth=2) == [[1.0, 2.0]]
