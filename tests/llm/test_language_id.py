import zlib

import numpy as np
import pytest

from robolog.llm import language_id
from robolog.llm.language_id import FEATURES, document_frequencies, fit_ftrl, fit_language, fit_temperature, gram_counts, identify, keep_identified

SF_DIR = "/root/testdata/sf0.01"


def test_counts_agree_with_a_plain_count():
    texts = ["", "a", "É b", "1 2", "ab!!cd", "  ab  cd ", "日本", "\x1c"]
    row, feature, count, lettered = gram_counts(texts)
    assert lettered.tolist() == [False, True, True, False, True, True, True, False]
    plain = [" ".join("".join(c if c.isalpha() else " " for c in f" {t.lower()} ").split()) for t in texts]
    for i, text in enumerate(plain):
        padded = f" {text} " if text else " "
        grams = sum(max(0, len(padded) - n + 1) for n in (1, 2, 3))
        assert count[row == i].sum() == grams, text
    # A text's counts do not depend on its neighbours, and equal texts have equal counts.
    alone = gram_counts([texts[4]])
    assert (alone[1] == feature[row == 4]).all() and (alone[2] == count[row == 4]).all()
    assert (feature[row == 4] == feature[row == 5]).all()


def test_ftrl_separates_and_its_penalty_leaves_noise_at_zero(monkeypatch):
    rng = np.random.default_rng(1)
    target = rng.integers(0, 3, size=300)
    rows = [(np.unique(np.append(rng.integers(100, FEATURES, size=20), [t, 10 + t])).astype(np.int32), None) for t in target]
    rows = [(f, np.full(len(f), 0.2, dtype=np.float32)) for f, _ in rows]
    dense = (fit_ftrl(rows, target, 3)[0] != 0).sum()
    monkeypatch.setattr(language_id, "L1", 0.02)
    w, bias = fit_ftrl(rows, target, 3)
    found = [int((v @ w[f] + bias).argmax()) for f, v in rows]
    assert np.mean(np.array(found) == target) > 0.95
    assert (w != 0).sum() < dense / 2  # ten times the penalty


def test_temperature_lowers_the_loss():
    logits = np.array([[4.0, 0.0], [0.0, 4.0], [4.0, 0.0], [0.0, 4.0]])
    assert fit_temperature(logits, np.array([0, 1, 1, 0])) > 10
    assert fit_temperature(logits, np.array([0, 1, 0, 1])) < 0.5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = fit_language(docs, per_language=150)
    found = {r.doc_id: r for r in identify(docs, model).collect()}
    known = {r.doc_id: r.lang for r in docs.collect()}
    assert len(found) == len(known)
    held = [i for i in known if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i, r in found.items() if r.held_out)
    assert np.mean([found[i].lang_pred == known[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    # Neither labels of held-out documents nor source and id are looked at.
    blind = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 'xx' ELSE lang END AS lang")
    assert {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, fit_language(blind, per_language=150)).collect()} == {i: (r.lang_pred, r.score) for i, r in found.items()}


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, t * 3, lang, "clash") for i, (t, lang) in enumerate([("the cat sat on the mat ", "en"), ("der hund und die katze ", "de"), ("the dog and a house ", "en"), ("ein haus mit garten ", "de")] * 12)]
    rows += [(900, None, "en", "x"), (901, "", None, None), (902, "12 34 !", "de", "x"), (None, "the mat", None, "x"), (903, "the hat " * 40_000, None, "x"), (903, "the hat", None, "x"), (903, "the hat", None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_nulls_and_letterless_texts(small):
    found = identify(small, fit_language(small)).collect()
    assert len(found) == small.count()
    by_id = {r.doc_id: r for r in found}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by_id[None].lang_pred == by_id[903].lang_pred == "en"
    kept = keep_identified(small, fit_language(small), 0.5)
    assert kept.columns == small.columns and kept.schema == small.schema
    assert {900, 901, 902}.isdisjoint(r.doc_id for r in kept.collect())


def test_empty_tables_and_no_labels(small):
    none = small.where("false")
    assert identify(none, fit_language(none)).count() == 0
    assert {r.lang_pred for r in identify(small.limit(3), fit_language(none)).collect()} == {"und"}


def test_document_frequencies_cover_all_rows(small):
    found = {r.feature: r.df for r in document_frequencies(small.repartition(5)).collect()}
    assert found[-1] == small.count()
    rows = [r.text or "" for r in small.collect()]
    row, feature, _, _ = gram_counts(rows)
    want = np.bincount(feature, minlength=FEATURES)
    assert {f: n for f, n in found.items() if f >= 0} == {int(f): int(want[f]) for f in np.flatnonzero(want)}
