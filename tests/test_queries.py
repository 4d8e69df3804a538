"""Every registered query next to its SQL, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "embeddings", "pages", "conversations"]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


def plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    df = driver.queries()[name](spark, SF_DIR)
    ours = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    found = db.execute(driver.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())
    assert ours == theirs


def test_entry(spark):
    first = driver.entry(spark)
    assert first.count() > 0
    assert first.schema == driver.entry(spark).schema
