import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from robolog.llm.manifest import document_manifest, fold, place_leaves, proof_digest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def digest(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout, siblings):
    """Root of a list of (digest, members); adds each member's (left, right) of every level to ``siblings``."""
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), fanout):
            run = nodes[at: at + fanout]
            for k, (_, members) in enumerate(run):
                for m in members:
                    siblings[m].append(("".join(x for x, _ in run[:k]), "".join(x for x, _ in run[k + 1:])))
            above.append((h(*(x for x, _ in run)), [m for _, members in run for m in members]))
        nodes = above
    return nodes[0]


def brute(rows, fanout):
    siblings = {i: [] for i in range(len(rows))}
    leaf = [digest((r[0], r[3], r[2], r[4], r[1])) for r in rows]
    trees = {}
    for i, r in enumerate(rows):
        trees.setdefault(("" if r[2] is None else "=" + r[2]).encode(), []).append(i)
    tops, subroot = [], {}
    for name in sorted(trees):
        order = sorted(trees[name], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        top = climb([(leaf[i], [i]) for i in order], fanout, siblings)
        subroot |= dict.fromkeys(order, top[0])
        tops.append(top)
    root = climb(tops, fanout, siblings)[0] if tops else None
    out = []
    for i, r in enumerate(rows):
        lowered = None if r[1] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1])
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        folded = digest((r[0], r[3], r[2], r[4], lowered)) if changed else leaf[i]
        for left, right in siblings[i]:
            folded = h(left, folded, right)
        out.append((r[0], leaf[i], subroot[i], root, h(*(a + b for a, b in siblings[i])), folded, folded == root))
    return sorted(out, key=str)


def found(df, fanout):
    out = document_manifest(df, fanout=fanout)
    folded = fold(F.col("changed_leaf"), F.col("path"))
    rows = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), folded.alias("f"), (folded == F.col("root")).alias("v"))
    return sorted(map(tuple, rows.collect()), key=str)


def some_rows(n):
    texts = ["Word", "word", "", None, "É é", "x" * 70_000, "MIXED Case"]
    return [(i * 7 % 1001, texts[i % 7], ["en", "en", "en", "de", "", None][i % 6], [None, "s"][i % 2], i, "clash", 5) for i in range(n)]


@pytest.mark.parametrize("fanout", [8, 2, 3])
def test_agrees_with_a_plain_tree(spark, fanout):
    rows = some_rows(150) + [(5, "Same", "en", "s", 1, "x", 0)] * 3 + [(None, "No id", "en", None, None, "x", 0)] * 9 + [(2, "Lone", "zz", "s", 1, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, fanout) == brute(rows, fanout)


def test_many_trees_of_one_row(spark):
    rows = [(i, "Text", f"lang{i}", "s", 1, None, None) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(df, 8)
    assert got == brute(rows, 8) and all(r[1] == r[2] for r in got)


def test_one_row_is_its_own_root_and_none_has_no_root(spark):
    df = spark.createDataFrame([(4, "Text", "en", None, None, None, None)], SCHEMA)
    (row,) = found(df, 8)
    assert row[1] == row[2] == row[3] and row[4] == hashlib.sha256(b"").hexdigest()
    assert found(df.where("false"), 8) == []


def test_a_change_is_noticed_and_a_text_without_capitals_stays(spark):
    rows = [(i, "Capital" if i % 2 else "small", "en", "s", 1, None, None) for i in range(100)]
    got = found(spark.createDataFrame(rows, SCHEMA), 8)
    for i, *_, verified in got:
        assert verified == (zlib.crc32(str(i).encode()) % 3 != 0 or i % 2 == 0)


def test_places_do_not_depend_on_how_rows_are_dealt(spark):
    leaves = spark.range(1000).select(F.when(F.col("id") % 2 == 0, "=a").otherwise("=b").alias("tree"), (F.col("id") % 50).alias("key"), F.lit("same").alias("leaf"))
    placed = place_leaves(leaves.repartition(7), "key")
    assert {(r.tree, r.idx) for r in placed.collect()} == {(t, i) for t in ("=a", "=b") for i in range(500)}
    assert placed.where("n <> 500").count() == 0
    held = [r.key for r in placed.where("tree = '=a'").orderBy("idx").collect()]
    assert held == sorted(held)
