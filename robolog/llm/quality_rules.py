"""Quality rules: exact counts of a text's repeats and symbols, and a calibrated n-gram classifier with a fixed threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from robolog.llm.common import body, give_back, once, pieces
from robolog.llm.linear import BagModel, WordNumbers, char_grams, class_odds, fit_in_one_task, labelled_sample, odds_shift, stack

#: Labelled rows of each class that the classifier is fitted on, at most.
SAMPLE_PER_CLASS = 1500
WORD_BITS, GRAM_BITS, GRAM = 17, 15, 3
MIN_WORDS, MOST_REPEATED_PERCENT, WINDOW = 20, 30, 8
#: A text is kept from this probability of being good on.
KEEP_FROM = 0.5
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_INNER = bytes(range(0x80, 0xC0))  # continuation bytes: all but the first of a code point
_SYMBOLS = b"#*$%&|<>"


def text_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    chars = len(text.translate(None, _SPACES + _INNER))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    dup_lines = 0
    if b"\n" in text:
        seen = set()
        for line in text.split(b"\n"):
            if line in seen:
                dup_lines += 1
            elif line and not line.isspace():
                seen.add(line)
    return chars, symbols, dup_lines, repeated_words(words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of ``window`` words that occurs at least twice in the text."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    # Windows as numbers that are equal only if the windows are: pairs of pairs of pairs, renumbered each time.
    width = 1
    while width < window:
        pair = ids[: len(ids) - width] << 32 | ids[width:]
        order = np.unique(pair, return_inverse=True)
        if len(order[0]) == len(pair):
            return 0  # no two are equal, so no longer windows are
        ids, width = order[1].reshape(-1).astype(np.int64), 2 * width
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def _bags(text: bytes, words: list[bytes], numbers: WordNumbers) -> list[np.ndarray]:
    words = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    return [words, char_grams(text, GRAM, GRAM_BITS)]


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", per_class: int = SAMPLE_PER_CLASS) -> bytes:
    """A logistic regression on hashed words and character n-grams for ``quality`` 0 or 1.

    Fitted on four fifths of a sample of at most ``per_class`` labelled rows of each class and calibrated
    on the rest, then moved to the class shares of the whole table of labels. Without labelled rows of both
    classes the model keeps every text.
    """
    odds = class_odds(labels, "quality")
    sample = labelled_sample(labels, docs.withColumn("sample_text", body(text)), "quality", per_class, key, ["sample_text"])

    def fit(rows: list[dict]) -> bytes:
        numbers = WordNumbers(WORD_BITS)
        model = BagModel([1 << WORD_BITS, 1 << GRAM_BITS])
        target = np.array([r["target"] for r in rows], dtype=np.int64)
        bags = [_bags(r["sample_text"], r["sample_text"].split(), numbers) for r in rows]
        held = np.arange(len(rows)) % 5 == 4
        if len(set(target[~held].tolist())) < 2:
            model.bias = 10.0
            return model.dump()
        model.fit([b for b, h in zip(bags, held, strict=True) if not h], target[~held])
        model.calibrate([b for b, h in zip(bags, held, strict=True) if h], target[held])
        model.shift += odds_shift(odds, target[held])
        return model.dump()

    return fit_in_one_task(sample, fit)


def apply_rules(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per row: ``key``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, p_quality, kept.

    Words are runs of bytes other than space and 0x09 to 0x0D. ``base_failed``: fewer than 20 words, or over
    30 percent of them in repeated windows of 8. ``kept``: not base_failed and a probability of at least
    ``keep_from``. A null text has no words. Rows are independent, so repeated rows and ids just come
    again; other columns are ignored; an empty table gives an empty result. Whole texts are read.
    """
    key_type = docs.schema[key].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        scorer = BagModel.load(model)
        numbers = once(("word numbers", WORD_BITS), lambda: WordNumbers(WORD_BITS))
        for batch in batches:
            texts = batch.column(1)
            for a, b in pieces(texts):
                counts, bags = [], []
                for x in texts.slice(a, b - a).to_pylist():
                    words = x.split()
                    counts.append((len(words), *text_counts(x, words)))
                    bags.append(_bags(x, words, numbers))
                found = np.array(counts, dtype=np.int64)
                p = scorer.probability(stack(bags, 2))
                failed = (found[:, 0] < MIN_WORDS) | (100 * found[:, 4] > MOST_REPEATED_PERCENT * found[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(found[:, i]) for i in range(5)), pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep_from))],
                    ["doc_id", *names, "base_failed", "p_quality", "kept"],
                )

    rows = docs.select(F.col(key).alias("doc_id"), body(text).alias("content"))
    schema = f"doc_id {key_type}, " + ", ".join(f"{n} bigint" for n in names) + ", base_failed boolean, p_quality double, kept boolean"
    return rows.mapInArrow(give_back(run), schema).withColumnRenamed("doc_id", key)
