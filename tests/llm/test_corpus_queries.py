"""The registered corpus queries next to their SQL, and the pipeline next to a plain version of its stages."""

import zlib
from collections import Counter

import duckdb
import pytest
from test_mixing import brute_mix  # noqa: F401
from test_similar import brute_classes
from test_simhash import lowered

import __spark_entry__ as driver
import corpus_pipeline
from robolog.llm.language_id import fit_language, identify
from robolog.llm.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
IDS = set(range(1, 14))


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == IDS
    assert set(driver.queries()) >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    found = db.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    assert Counter(tuple(r[c] for c in sorted(names)) for r in df.collect()) == Counter(tuple(r[i] for i in order) for r in found.fetchall())


def test_pipeline_agrees_with_its_stages_on_plain_rows(spark):
    import public_tokenizers
    import sentencepiece

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, list(r.ids)) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    named = {r.doc_id for r in identify(docs, fit_language(docs)).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    last = {}
    for i in sorted(named):
        last[lowered(texts[i])] = i
    ids = sorted(last.values())
    kept = sorted(set(brute_classes([texts[i] for i in ids], ids)))
    rows = {r.doc_id: r for r in docs.collect()}
    chosen = corpus_pipeline.mix(
        spark.createDataFrame([tuple(rows[i]) for i in kept], docs.schema), corpus_pipeline.source_domain(), corpus_pipeline.MIX_WEIGHTS,
        budget_percent=95, max_epochs=1, seed=corpus_pipeline.MIX_SEED, keep=["doc_id"])
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {r.doc_id: [1, *library.encode(texts[r.doc_id]), 2] for r in chosen.collect()}
    assert found == {i: (len(x), x) for i, x in want.items()}


def test_stages_handle_edge_cases(spark, tmp_path):
    rows = [
        (1, "the cat sat on the mat and saw a dog", "en", "src1", 30), (1, "the cat sat on the mat and saw a dog", "en", "src1", 30),
        (2, "The Cat sat on the mat and saw a dog", "en", "src2", 30), (3, None, None, None, None), (4, "", "en", "src1", 0),
        (5, "12345", "de", "src0", 5), (None, "ein hund und eine katze im garten", "de", None, None), (6, "der hund und die katze " * 9000, "de", "src0", 1),
        *[(10 + i, f"the dog and the house number {i} in the street", "en", "src3", 1) for i in range(40)],
        *[(60 + i, f"der hund und das haus Nummer {i} in der Strasse", "de", "src4", 1) for i in range(40)],
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, mix_tokens string")
    for label, table in (("rows", docs), ("none", docs.where("false"))):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, "")
            if k < 4:
                assert out.columns == docs.columns, name
            path = f"file://{tmp_path}/{label}{k}"
            out.write.parquet(path)
            table = spark.read.parquet(path)
        assert (table.count() > 0) == (label == "rows")
        assert table.where("doc_id IN (3, 4, 5)").count() == 0


def test_held_out_rule_is_the_contracts(spark):
    found = QUERIES[next(n for n in QUERIES if n.startswith("op3_"))](spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
