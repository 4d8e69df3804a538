import hashlib
import random

import pytest
from pyspark.sql import functions as F

from robolog.llm.exact_dedup import ContentTable, drop_exact, exact_groups, grace

SCHEMA = "doc_id long, text string, digest string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(lowered(text), []).append(i)
    return sorted(
        (i, max(groups[lowered(t)]), len(groups[lowered(t)]), i == max(groups[lowered(t)]), hashlib.sha256(lowered(t).encode()).hexdigest())
        for i, t in rows
    )


@pytest.mark.parametrize("table_bytes", [1 << 26, 200])
def test_groups_agree_with_brute_force(spark, table_bytes):
    random.seed(1)
    texts = ["", None, "É", "é", "A b", "a B", "x" * 200_000, "X" * 200_000] + [f"text {i}" * (i % 7) for i in range(40)]
    rows = [(i, random.choice(texts)) for i in range(300)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(7)
    assert sorted(map(tuple, exact_groups(df, table_bytes=table_bytes).collect())) == brute(rows)


def test_spilled_buckets_give_each_content_once():
    rows = [(hashlib.sha256(str(i % 50).encode()).digest(), str(i % 50).encode() * 40, i, 1) for i in range(500)]
    found = {bytes(r[1]): (r[2], r[3]) for r in grace(iter(rows), 300)}
    assert len(found) == 50 and found[b"7" * 40] == (457, 10)


def test_contents_that_share_a_digest_fail_the_run():
    table = ContentTable()
    table.add(b"d" * 32, b"one", 1, 1)
    with pytest.raises(ValueError, match="share the digest"):
        table.add(b"d" * 32, b"two", 2, 1)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (None, "b", "x"), (None, "a", "x"), (2, "c", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = exact_groups(df)
    assert found.count() == 5
    assert sorted((r.keep_id is None, r.keep_id or 0, r.group_size) for r in found.where("kept").collect()) == [(False, 1, 3), (False, 2, 1), (True, 0, 1)]
    kept = drop_exact(df)
    assert kept.columns == df.columns and sorted(r.text for r in kept.collect()) == ["a", "b", "c"]
    assert exact_groups(df.where("false")).count() == 0 and drop_exact(df.where("false")).count() == 0


def test_kept_rows_keep_their_columns(spark):
    df = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 9).cast("string").alias("text"), F.lit(1).alias("keep_id"))
    assert sorted(r.doc_id for r in drop_exact(df).collect()) == list(range(91, 100))


def test_a_text_with_an_invalid_byte_keeps_one_copy(spark):
    df = spark.sql("SELECT id AS doc_id, CAST(IF(id < 3, X'61FF41', IF(id < 5, X'61FE41', X'61C3A9C3')) AS STRING) AS text FROM range(7)")
    assert sorted(r.doc_id for r in drop_exact(df).select("doc_id").collect()) == [2, 4, 6]
    assert sorted(r.doc_id for r in exact_groups(df).where("kept").collect()) == [2, 4, 6]
