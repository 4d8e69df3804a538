"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

Both views are log-ratio models: a feature weighs the logarithm of its share in good documents over its share
in bad ones. Shares are sums over documents, so every round goes over all documents without a label, at any
size, and one aggregate by label and feature gives the next models.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from robolog.llm.common import body, give_back, once, pieces
from robolog.llm.linear import MOST_LOGIT, BagModel, WordNumbers, char_grams, class_odds, labelled_sample, odds_shift, stack
from robolog.operators.joins import BROADCAST_BYTES, side_join, table_size
from robolog.session import materialize, write_once

#: Labelled rows of each class that the classifiers start from and are calibrated on, at most.
LABELLED_PER_CLASS = 1000
#: Rounds of teaching, and the probability from which on a view teaches a document to the other.
ROUNDS, SURE = 3, 0.95
WORD_BITS, GRAM_BITS, GRAM, META_BITS = 16, 14, 4, 12
#: Features of each bag: words and letter grams of the text view, then the metadata view.
WIDTHS = [1 << WORD_BITS, 1 << GRAM_BITS, 1 << META_BITS]
TEXT_BAGS = 2
#: What the features of one document weigh together, in whole numbers so that sums do not depend on their order.
UNIT = 1 << 24
KEEP_FROM = 0.5
META = ["source", "lang", "n_chars"]


def _text_bags(text: bytes, numbers: WordNumbers) -> list[np.ndarray]:
    words = text.split()
    return [np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)), char_grams(text, GRAM, GRAM_BITS)]


def _meta_bags(source: str | None, lang: str | None, n_chars: int | None, numbers: WordNumbers) -> list[np.ndarray]:
    """Where a page comes from, its language, its length by half powers of two, and pairs of these."""
    size = "none" if n_chars is None else str(int(2 * math.log2(max(1, n_chars))))
    names = [f"s={source}", f"l={lang}", f"n={size}", f"l={lang} n={size}", f"s={source} l={lang}"]
    return [np.array([numbers[x.encode()] for x in names], dtype=np.int64)]


class CoTrained:
    """Two calibrated views and the weights with which their log-odds are added."""

    def __init__(self, text: BagModel, meta: BagModel, mixed: np.ndarray):
        self.text, self.meta, self.mixed = text, meta, mixed

    def score(self, text_bags, meta_bags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(text_bags), self.meta.logit(meta_bags)
        both = np.clip(self.mixed[0] * a + self.mixed[1] * b + self.mixed[2], -MOST_LOGIT, MOST_LOGIT)
        return tuple(1 / (1 + np.exp(-x)) for x in (a, b, both))

    def dump(self) -> bytes:
        first = self.text.dump()
        return np.int64(len(first)).tobytes() + self.mixed.astype(np.float64).tobytes() + first + self.meta.dump()

    @staticmethod
    def load(data: bytes) -> CoTrained:
        size = int(np.frombuffer(data, np.int64, 1)[0])
        return CoTrained(BagModel.load(data[32 : 32 + size]), BagModel.load(data[32 + size :]), np.frombuffer(data, np.float64, 3, 8))


def log_ratios(mass: np.ndarray) -> list[BagModel]:
    """The two views from the summed features of bad (row 0) and good documents (row 1).

    Shares are smoothed by an even share, so that a feature of neither class weighs nothing, however
    many documents the classes have.
    """
    models, at = [BagModel(WIDTHS[:TEXT_BAGS]), BagModel(WIDTHS[TEXT_BAGS:])], 0
    for model in models:
        for k, width in enumerate(map(len, model.weights)):
            part = mass[:, at : at + width].astype(np.float64)
            bad, good = part / np.maximum(part.sum(axis=1, keepdims=True), 1) + 1 / width
            model.weights[k] = np.log(good / bad).astype(np.float32).astype(np.float64)
            at += width
    return models


def _bags_of(part: pa.RecordBatch) -> tuple[list, list]:
    """Stacked bags of both views, of rows with the columns content, source, lang, n_chars first."""
    words, metas = (once(("co-training", b), lambda b=b: WordNumbers(b)) for b in (WORD_BITS, META_BITS))
    texts = [_text_bags(x, words) for x in part.column(0).to_pylist()]
    meta = [_meta_bags(*row, metas) for row in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
    return stack(texts, TEXT_BAGS), stack(meta, 1)


def _add(mass: np.ndarray, bags: list, at: int, labels: np.ndarray) -> None:
    """Add the features of the documents whose label is 0 or 1 to the sums of that label, from feature ``at`` on."""
    for numbers, counts in bags:
        width = WIDTHS[0 if at == 0 else 1 if at == WIDTHS[0] else 2]
        each, label = np.repeat(np.maximum(UNIT // np.maximum(counts, 1), 1), counts), np.repeat(labels, counts)
        for y in (0, 1):
            mine = label == y
            mass[y, at : at + width] += np.bincount(numbers[mine], weights=each[mine], minlength=width).astype(np.int64)
        at += width


def feature_sums(rows: DataFrame, teachers: bytes | None = None, sure: float = SURE) -> np.ndarray:
    """Summed features by label, over all ``rows`` (content, source, lang, n_chars, target).

    Without ``teachers`` the label of both views is the target. With them the text view is given the labels that
    the metadata view is at least ``sure`` of, and the other way round; other documents count for nothing.
    A task sends its sums by label and feature, at most as many rows as there are features.
    """
    def run(batches):
        mass = np.zeros((2, sum(WIDTHS)), dtype=np.int64)
        both = None if teachers is None else CoTrained.load(teachers)
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                part = batch.slice(a, b - a)
                text, meta = _bags_of(part)
                if both is None:
                    for_text = for_meta = np.array([-1 if y is None else y for y in part.column(4).to_pylist()], dtype=np.int64)
                else:
                    p_text, p_meta, _ = both.score(text, meta)
                    for_text, for_meta = (np.where(p >= sure, 1, np.where(p <= 1 - sure, 0, -1)) for p in (p_meta, p_text))
                _add(mass, text, 0, for_text)
                _add(mass, meta, sum(WIDTHS[:TEXT_BAGS]), for_meta)
        label, feature = np.nonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(feature, pa.int32()), pa.array(mass[label, feature])], ["label", "feature", "mass"])

    parts = rows.select("content", *META, "target").mapInArrow(give_back(run), "label int, feature int, mass bigint")
    found = parts.groupBy("label", "feature").agg(F.sum("mass").alias("mass")).toArrow()
    mass = np.zeros((2, sum(WIDTHS)), dtype=np.int64)
    mass[found["label"].to_numpy(), found["feature"].to_numpy()] = found["mass"].to_numpy()
    return mass


def _raw_odds(held: DataFrame, models: list[BagModel]) -> tuple[np.ndarray, np.ndarray]:
    """Targets and both views' log-odds before calibration, of the bounded rows held back; in the order of the data."""
    data = CoTrained(*models, np.zeros(3)).dump()

    def run(batches):
        both = CoTrained.load(data)
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                part = batch.slice(a, b - a)
                text, meta = _bags_of(part)
                yield pa.RecordBatch.from_arrays([part.column(4), pa.array(both.text.raw(text)), pa.array(both.meta.raw(meta))], ["target", "text", "meta"])

    found = held.select("content", *META, "target").mapInArrow(give_back(run), "target int, text double, meta double")
    got = sorted((r.target, r.text, r.meta) for r in found.collect())
    return np.array([r[0] for r in got], dtype=np.int64), np.array([r[1:] for r in got], dtype=np.float64).reshape(-1, 2)


def calibrated(models: list[BagModel], target: np.ndarray, raw: np.ndarray, odds: float) -> CoTrained:
    """Both views scaled on rows held back, the weights of their sum, and all log-odds moved to ``odds``."""
    for k, model in enumerate(models):
        model.calibrate_raw(raw[:, k], target)
    x = np.stack([np.clip(m.slope * raw[:, k] + m.shift, -MOST_LOGIT, MOST_LOGIT) for k, m in enumerate(models)], axis=1)
    mixed, shift = _sum_weights(x, target), odds_shift(odds, target)
    mixed[2] += shift - shift * (mixed[0] + mixed[1])  # the views are moved too
    for model in models:
        model.shift += shift
    return CoTrained(*models, mixed)


def _sum_weights(x: np.ndarray, target: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights (not negative) and shift of the sum of two log-odds, by Newton steps drawn towards their mean."""
    w, start = np.array([0.5, 0.5, 0.0]), np.array([0.5, 0.5, 0.0])
    if len(set(target.tolist())) < 2:
        return w
    x = np.column_stack([x, np.ones(len(x))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -MOST_LOGIT, MOST_LOGIT)))
        h = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + np.eye(3)
        w = w - np.linalg.solve(h, x.T @ (p - target) + (w - start))
        w[:2] = np.maximum(w[:2], 0)
    return w


def _without_label(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """The rows whose id has no label, rows without an id among them.

    The ids are measured: up to the bound they are broadcast and every pass reads the input in place; beyond it
    the texts are shuffled once and written, not once a round.
    """
    known = materialize(labels.where("quality IS NOT NULL").select(F.col(key).alias("known_id")).where("known_id IS NOT NULL").distinct())
    size = table_size(known)[1]
    rest = side_join(rows.withColumnRenamed("row_id", "known_id"), known, ["known_id"], "left_anti", size=size)
    return rest if size <= BROADCAST_BYTES else write_once(rest)


def fit_co_training(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", per_class: int = LABELLED_PER_CLASS, rounds: int = ROUNDS, seed: int = 17) -> bytes:
    """Fit on at most ``per_class`` labelled documents of each class, chosen by a seeded hash of the id, and on all documents without a label.

    Every fourth labelled row of a class is held back: on these the views are calibrated and the weights of their
    sum are fitted; all log-odds are moved to the class shares of the whole table of labels. In a round
    each view labels every document it is sure of, and the other is made anew from the sums of the labelled rows
    and of what it was taught. Labels are weighed again in every round, so one given in error can be taken back. The
    driver holds sums by feature and the log-odds of the rows held back, both of fixed size. Without labelled
    rows of both classes everything counts as good.
    """
    rows = docs.select(F.col(key).alias("row_id"), body(text).alias("content"), *_meta_columns())
    sample = labelled_sample(labels, rows.withColumnRenamed("row_id", key), "quality", per_class, key, ["content", *META], seed)
    place = F.row_number().over(Window.partitionBy("target").orderBy("sample_order"))
    sample = write_once(sample.withColumn("held", place % 4 == 0).drop("sample_order"))
    known, held = feature_sums(sample.where("NOT held")), sample.where("held")
    if not known.any(axis=1).all():
        models = log_ratios(np.zeros_like(known))
        for model in models:
            model.bias = 10.0
        return CoTrained(*models, np.array([0.5, 0.5, 0.0])).dump()
    odds, rest = class_odds(labels, "quality"), _without_label(rows, labels, key).withColumn("target", F.lit(None).cast("int"))
    mass = known
    for turn in range(rounds + 1):
        models = log_ratios(mass)
        model = calibrated(models, *_raw_odds(held, models), odds).dump()
        if turn < rounds:
            mass = known + feature_sums(rest, model)
    return model


def _meta_columns() -> list[Column]:
    return [F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("bigint").alias("n_chars")]


def score_quality(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per row: ``key``, p_text, p_meta, score, kept (score of at least ``keep_from``).

    p_text looks only at the text, p_meta only at source, lang and n_chars; score joins both. A null text is
    empty, null metadata are values of their own. Rows are independent, so repeated rows and ids just come
    again; other columns are ignored; an empty table gives an empty result. Whole texts are read.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        both = CoTrained.load(model)
        for batch in batches:
            for a, b in pieces(batch.column(0)):
                part = batch.slice(a, b - a)
                p_text, p_meta, score = both.score(*_bags_of(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column(4), pa.array(p_text), pa.array(p_meta), pa.array(score), pa.array(score >= keep_from)],
                    ["doc_id", "p_text", "p_meta", "score", "kept"],
                )

    rows = docs.select(body(text).alias("content"), *_meta_columns(), F.col(key).alias("doc_id"))
    return rows.mapInArrow(give_back(run), f"doc_id {key_type}, p_text double, p_meta double, score double, kept boolean").withColumnRenamed("doc_id", key)
