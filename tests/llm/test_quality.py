import random
import re
from collections import Counter
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from robolog.llm.co_training import SURE, UNIT, WIDTHS, CoTrained, _meta_bags, _text_bags, calibrated, feature_sums, fit_co_training, log_ratios, score_quality
from robolog.llm.linear import BagModel, WordNumbers, labelled_sample, odds_shift, stack
from robolog.llm.quality_rules import apply_rules, fit_quality, text_counts

SF_DIR = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = [False] * len(words)
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(hit)


TEXTS = [None, "", " \n\t ", "a", "é\x1cb", "x\nx\n \n \ny\nx", "one two\r\none two\r\n", "#*$%&|<>", "a b c d e f g h " * 2, "a b c d e f g h i " * 3, "w " * 100_000, "Hati " * 30]


def test_counts_agree_with_brute_force():
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(["a ", "b ", "é", "\n", "# ", "c d e f g h i j ", "\x0b", "日 "]) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    for text in texts:
        content = (text or "").encode()
        words = content.split()
        assert (len(words), *text_counts(content, words)) == brute(text)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


def test_rules_on_the_documents(tables):
    docs, labels = tables
    found = {r.doc_id: r for r in apply_rules(docs, fit_quality(docs, labels)).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == len(texts)
    for i, text in texts.items():
        r, counts = found[i], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert r.kept == (not r.base_failed and r.p_quality >= 0.5)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    good = [found[i] for i, q in quality.items() if q == 1 and i in found and not found[i].base_failed]
    assert np.mean([r.kept for r in good]) > 0.98
    assert np.mean([found[i].kept for i, q in quality.items() if q == 0 and i in found]) < 0.3


def test_co_training_on_the_documents(tables):
    docs, labels = tables
    found = {r.doc_id: r for r in score_quality(docs, fit_co_training(docs, labels)).collect()}
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found.values())
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([found[i].kept for i, q in quality.items() if q == 1 and i in found]) > 0.97
    assert np.mean([found[i].kept for i, q in quality.items() if q == 0 and i in found]) < 0.35


def made_rows(n, labelled, seed=2, vocabulary=90):
    """Documents whose source and words (letters without a pattern) give their class away, in a fixed order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.randint(0, 1)
        words = [md5(f"{y} {rng.randint(1, vocabulary)}".encode()).hexdigest()[:7] for _ in range(8)]
        rows.append((i, " ".join(words), f"s{y}", "en", 100, y))
    return [r if r[0] < labelled else (*r[:5], None) for r in rows], [r[5] for r in rows]


def as_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, truth int")
    return docs.drop("truth").repartition(5), docs.where("truth IS NOT NULL").select("doc_id", F.col("truth").alias("quality"))


def test_views_teach_each_other(spark):
    """Labels are few; the metadata gives the class away, so the text view learns its words from pseudo-labels."""
    rows, truth = made_rows(2000, 240, vocabulary=8000)
    docs, labels = as_tables(spark, rows)

    def accuracy(rounds):
        found = score_quality(docs, fit_co_training(docs, labels, rounds=rounds)).collect()
        return np.mean([(r.p_text > 0.5) == truth[r.doc_id] for r in found])

    assert _meta_bags(None, None, None, WordNumbers(12))[0].shape == (5,)
    alone, taught = accuracy(0), accuracy(3)
    assert alone < 0.9 < 0.98 < taught


def test_co_training_agrees_with_a_plain_loop(spark):
    rows = made_rows(400, 240, seed=5)[0] + [(500, None, None, None, None, None), (None, "alpha1", "s1", "en", 3, None), (700, "iota2 iota2", "s0", "en", 9, None)]
    docs, labels = as_tables(spark, rows)
    model = CoTrained.load(fit_co_training(docs, labels, per_class=1000, rounds=2))
    # The sample's order decides which rows are held back; the rest is worked out one document and one feature at a time.
    sample = labelled_sample(labels, docs.select("doc_id", F.encode("text", "utf-8").alias("content"), "source", "lang", "n_chars"), "quality", 1000, "doc_id", ["content", "source", "lang", "n_chars"], 17)
    sample = sorted(sample.collect(), key=lambda r: r.sample_order)
    words, metas = WordNumbers(16), WordNumbers(12)

    def bags(r):
        content = r["content"] if "content" in r else (r["text"] or "").encode()
        return _text_bags(bytes(content), words), _meta_bags(r["source"], r["lang"], r["n_chars"], metas)

    held, known = [], []
    for y in (0, 1):
        for i, r in enumerate([r.asDict() for r in sample if r.target == y]):
            (held if i % 4 == 3 else known).append((bags(r), y))
    ids = {r.doc_id for r in labels.collect()}
    rest = [bags(r.asDict()) for r in docs.collect() if r.doc_id not in ids]
    assert len(rest) == len(rows) - len(ids)
    odds = (sum(r.quality for r in labels.collect()) + 0.5) / (sum(1 - r.quality for r in labels.collect()) + 0.5)

    def add(mass, bag, at, label):
        for f in bag.tolist():
            mass[label, at + f] += max(1, UNIT // len(bag))

    start = np.zeros((2, sum(WIDTHS)), dtype=np.int64)
    for (text, meta), y in known:
        add(start, text[0], 0, y), add(start, text[1], WIDTHS[0], y), add(start, meta[0], WIDTHS[0] + WIDTHS[1], y)
    mass = start
    for turn in range(3):
        views = log_ratios(mass)
        raw = np.array([[views[0].raw(stack([t], 2))[0], views[1].raw(stack([m], 1))[0]] for (t, m), _ in held])
        order = sorted(range(len(held)), key=lambda i: (held[i][1], *raw[i]))
        both = calibrated(views, np.array([held[i][1] for i in order]), raw[order], odds)
        if turn == 2:
            break
        mass, taught = start.copy(), [0, 0]
        for text, meta in rest:
            p_text, p_meta, _ = (float(p[0]) for p in both.score(stack([text], 2), stack([meta], 1)))
            for view, p in ((0, p_meta), (1, p_text)):
                label = 1 if p >= SURE else 0 if p <= 1 - SURE else None
                if label is None:
                    continue
                taught[view] += 1
                if view:
                    add(mass, meta[0], WIDTHS[0] + WIDTHS[1], label)
                else:
                    add(mass, text[0], 0, label), add(mass, text[1], WIDTHS[0], label)
        assert min(taught) > 20
    for mine, plain in ((model.text, both.text), (model.meta, both.meta)):
        assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(mine.weights, plain.weights))
        assert (mine.slope, mine.shift) == pytest.approx((plain.slope, plain.shift), rel=1e-4)
    assert model.mixed == pytest.approx(both.mixed, rel=1e-4, abs=1e-5)


def test_all_documents_without_a_label_are_taught(spark):
    """Sums grow with the table: three times the documents give three times the taught mass."""
    docs, labels = as_tables(spark, made_rows(400, 200)[0])
    model = fit_co_training(docs, labels)
    rows = docs.select(F.encode("text", "utf-8").alias("content"), "source", "lang", "n_chars", F.lit(None).cast("int").alias("target"))
    assert (feature_sums(rows.union(rows).union(rows), model) == 3 * feature_sums(rows, model)).all()


@pytest.mark.parametrize("fit, use", [(fit_quality, apply_rules), (fit_co_training, score_quality)])
def test_edge_cases(spark, fit, use):
    rows = [(i, t, "en", "s", 5, "clash") for i, t in enumerate(TEXTS)] + [(3, "a", None, None, None, None), (3, "a", None, None, None, None), (None, "b", None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, target string")
    labels = spark.createDataFrame([(0, 1, None), (1, None, 1), (None, 1, 1), (3, 0, 0), (3, 0, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    assert use(docs, fit(docs, labels)).count() == len(rows)
    none = labels.where("false")
    found = use(docs, fit(docs, none)).collect()
    assert len(found) == len(rows)
    empty = docs.where("false")
    assert use(empty, fit(empty, none)).count() == 0


def test_samples_are_bounded_and_balanced(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    labels = spark.range(500).selectExpr("id AS doc_id", "cast(id % 10 = 0 AS int) AS quality")
    found = labelled_sample(labels, docs, "quality", 40, "doc_id", ["text"])
    assert {(r["target"], r["count"]) for r in found.groupBy("target").count().collect()} == {(0, 40), (1, 40)}


def test_calibration_follows_the_class_shares():
    rng = np.random.default_rng(3)
    target = rng.integers(0, 2, size=400)
    docs = [[np.array([1 + t if rng.random() < 0.9 else 2 - t])] for t in target]
    model = BagModel([8]).fit(docs, target).calibrate(docs, target)
    p = model.probability(stack([[np.array([1])], [np.array([2])]], 1))
    assert abs(p[0] - 0.1) < 0.06 and abs(p[1] - 0.9) < 0.06
    model.shift += odds_shift(9.0, target)
    assert model.probability(stack([[np.array([1])]], 1))[0] > 0.4
    assert BagModel.load(model.dump()).probability(stack(docs[:5], 1)) == pytest.approx(model.probability(stack(docs[:5], 1)), abs=1e-5)
