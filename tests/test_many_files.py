"""Datasets of more files than a chunk holds, next to their SQL."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """60,000 vectors: the small table 120 times with shifted keys, of which the last episode starts beyond file 1000."""
    folder = str(tmp_path_factory.mktemp("many"))
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    shifted = vectors.crossJoin(spark.range(120)).withColumn("vec_id", F.col("vec_id") + 500 * F.col("id")).drop("id")
    shifted.coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    return folder, db


@pytest.mark.parametrize("name", ["build_dataset", "dataset_append"])
def test_files_are_numbered_over_all_chunks(spark, copies, name):
    folder, db = copies
    df = driver.queries()[name](spark, folder)
    found = db.execute(driver.oracle_sql()[name])
    names = [d[0] for d in found.description]
    ours, theirs = Counter(tuple(r[c] for c in names) for r in df.collect()), Counter(found.fetchall())
    assert sorted(names) == sorted(df.columns) and ours == theirs
    assert max(row[names.index("file_index")] for row in theirs) > 1000
