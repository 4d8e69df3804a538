"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, fitted with FTRL."""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from robolog.llm.common import body, give_back, once, pieces
from robolog.operators.joins import side_join

#: Character n-grams of 1 to 3 code points are hashed into so many features.
FEATURE_BITS, ORDERS = 15, (1, 2, 3)
FEATURES = 1 << FEATURE_BITS
#: Expected number of labelled documents of each language that the model is fitted on, and passes over them.
SAMPLE_PER_LANGUAGE, PASSES = 1200, 4
#: Follow-the-regularised-leader: learning rate, its offset, elastic-net penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-4
UNDETERMINED = "und"
#: Documents whose n-grams are counted at once.
ROWS = 48


def letter_table() -> np.ndarray:
    """For each code point: its lower-case form if it is a letter, else a space; 0 marks surrogates."""
    def build():
        table = np.full(0x110000, 32, dtype=np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                low = c.lower()
                table[code] = ord(low) if len(low) == 1 else code
        return table

    return once("letters", build)


#: Odd multipliers that hash the n-grams of each order.
MULTIPLIERS = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F, 3: 0x165667B19E3779F9}


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of the hashed n-grams each text has (by row and feature), and whether a text has a letter.

    Other characters than letters count as spaces, runs of them as one; a text counts as standing between spaces.
    """
    table = letter_table()
    codes = [np.frombuffer(f" {x} ".encode("utf-32-le", "replace"), dtype=np.uint32) for x in texts]
    lengths = np.array([len(c) for c in codes])
    flat = table[np.concatenate(codes)]
    space = flat == 32
    again = np.append(False, space[1:] & space[:-1])
    starts = np.cumsum(lengths) - lengths
    again[starts] = False
    dropped = np.add.reduceat(again, starts, dtype=np.int64)
    flat, lengths = flat[~again].astype(np.uint64), lengths - dropped
    ends = np.cumsum(lengths)
    lettered = lengths > 1 + (np.maximum.reduceat(flat, ends - lengths) == 32)
    base = np.repeat(np.arange(len(texts)) << FEATURE_BITS, lengths)
    spare = len(texts) << FEATURE_BITS  # takes what reaches across two texts
    found, gram = [], np.zeros(len(flat), dtype=np.uint64)
    for n in ORDERS:
        size = len(flat) - n + 1
        if size <= 0:
            break
        gram = (gram[:size] << np.uint64(21)) | flat[n - 1 :]
        feature = (gram * np.uint64(MULTIPLIERS[n]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        feature += base[:size]
        for back in range(1, n):
            across = ends[:-1] - back
            feature[across[(across >= 0) & (across < size)]] = spare
        found.append(feature)
    counts = np.bincount(np.concatenate(found), minlength=spare + 1)[:spare]
    at = np.flatnonzero(counts)
    return at >> FEATURE_BITS, at & (FEATURES - 1), counts[at], lettered


def tf_idf(row: np.ndarray, feature: np.ndarray, count: np.ndarray, idf: np.ndarray, n_rows: int) -> np.ndarray:
    """Log frequencies times inverse document frequencies, each row of length 1."""
    x = np.log1p(count) * idf[feature]
    length = np.sqrt(np.bincount(row, weights=x * x, minlength=n_rows))
    return (x / np.maximum(length, 1e-12)[row]).astype(np.float32)


class LanguageModel:
    """Languages, inverse document frequencies, weights (features by languages), biases and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.languages, self.idf, self.weights, self.bias, self.temperature = languages, idf, weights, bias, temperature

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        row, feature, count, lettered = gram_counts(texts)
        x = tf_idf(row, feature, count, self.idf, len(texts))
        p = softmax(row_products(row, feature, x, self.weights, self.bias, len(texts)) / self.temperature)
        best = p.argmax(axis=1)
        names = [self.languages[i] if ok else UNDETERMINED for i, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return names, np.where(lettered, p[np.arange(len(texts)), best], 0.0).astype(np.float64)

    def dump(self) -> bytes:
        used = np.flatnonzero(np.abs(self.weights).sum(axis=1) > 0)  # the penalty leaves most weights at zero
        out = io.BytesIO()
        np.savez_compressed(out, languages=np.array(self.languages, dtype=np.str_), used=used, weights=self.weights[used].astype(np.float32), idf=self.idf.astype(np.float32), bias=self.bias, temperature=self.temperature)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> LanguageModel:
        held = np.load(io.BytesIO(data))
        languages = held["languages"].tolist()
        weights = np.zeros((FEATURES, len(languages)), dtype=np.float32)
        weights[held["used"]] = held["weights"]
        return LanguageModel(languages, held["idf"], weights, held["bias"].astype(np.float32), float(held["temperature"]))


def row_products(row: np.ndarray, feature: np.ndarray, x: np.ndarray, weights: np.ndarray, bias: np.ndarray, n_rows: int) -> np.ndarray:
    """Sparse rows times weights, plus biases. Every row has at least one entry."""
    starts = np.searchsorted(row, np.arange(n_rows))
    return np.add.reduceat(weights[feature] * x[:, None], starts, axis=0) + bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, n_classes: int, passes: int = PASSES, batch: int = 16, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal with L1 and L2 penalties, over small batches in a seeded order.

    A row is its features and their values. z holds the shifted gradient sums and n their squares; a weight
    is zero as long as its z is within L1.
    """
    z, n, w = (np.zeros((FEATURES + 1, n_classes), dtype=np.float32) for _ in range(3))
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for some in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
            features, values = (np.concatenate(part) for part in zip(*(rows[i] for i in some), strict=True))
            touched, at = np.unique(features, return_inverse=True)
            own = np.zeros((len(some), len(touched)), dtype=np.float32)
            own[np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some]), at] = values
            p = softmax(own @ w[touched] + w[-1])
            p[np.arange(len(some)), target[some]] -= 1
            g = np.vstack([own.T @ p, p.sum(axis=0)]) / len(some)
            at = np.append(touched, FEATURES)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w[at]
            n[at] += g * g
            l1 = np.full((len(at), 1), L1, dtype=np.float32)
            l1[-1] = 0  # the bias is not penalised
            w[at] = np.where(np.abs(z[at]) <= l1, 0, -(z[at] - np.sign(z[at]) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature of least log loss on documents that were not fitted, by golden-section search of its logarithm."""
    if not len(target):
        return 1.0
    loss = lambda t: -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(target)), target], 1e-12)).mean()
    a, b, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def held_out(key: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id as text is divisible by 5: such documents are never learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """feature, df: in how many of the documents each hashed n-gram occurs; feature -1 counts the documents."""
    def count(batches):
        total, seen = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for a, b in pieces(batch.column(0), 1 << 19):
                rows = [x.decode("utf-8", "replace") for x in batch.column(0).slice(a, b - a).to_pylist()]
                for i in range(0, len(rows), ROWS):
                    total += np.bincount(gram_counts(rows[i : i + ROWS])[1], minlength=FEATURES)
                seen += len(rows)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], seen))], ["feature", "df"])

    found = docs.select(body(text).alias("content")).mapInArrow(give_back(count), "feature bigint, df bigint")
    return found.groupBy("feature").agg(F.sum("df").alias("df"))


def language_sample(docs: DataFrame, key: str, text: str, lang: str, per_language: int, seed: int = 11) -> DataFrame:
    """Labelled documents that may be learned from, about ``per_language`` of each language, by a seeded hash of the id."""
    known = docs.where(F.col(lang).isNotNull() & ~held_out(key)).select(F.col(key).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    unit = (F.xxhash64(F.lit(seed), "doc_id") / 2.0**64 + 0.5)
    # A row for each language: measured, and broadcast if small, so that no text is shuffled by its language.
    found = side_join(known, sizes, ["lang"], "inner").where(unit < F.lit(float(per_language)) / F.col("n"))
    return found.select("lang", body("text").alias("content"), F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("sample_order"))


def fit_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> bytes:
    """Learn from ``text`` and non-null ``lang`` of the documents that are not held out.

    Document frequencies are those of all such documents. The weights are fitted in one task on a sample
    of about ``per_language`` documents of each language; every fifth of these sets the temperature.
    """
    usable = docs.where(F.col(lang).isNotNull() & ~held_out(key))
    found = document_frequencies(usable, text).collect()  # one row for each of 2^15 features at most
    df = np.zeros(FEATURES, dtype=np.float64)
    total = 0
    for row in found:
        if row["feature"] < 0:
            total = row["df"]
        else:
            df[row["feature"]] = row["df"]
    idf = np.where(df > 0, np.log((1 + total) / (1 + df)) + 1, 0).astype(np.float32)

    def run(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([fit_rows(rows, idf)], pa.binary())], ["model"])

    sample = language_sample(docs, key, text, lang, per_language)
    fitted = sample.repartition(1).sortWithinPartitions("sample_order").mapInArrow(give_back(run), "model binary").collect()
    return bytes(fitted[0]["model"]) if fitted else fit_rows([], idf)


def fit_rows(rows: list[dict], idf: np.ndarray) -> bytes:
    """A model from sampled rows (lang, content); without rows it knows no language."""
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return LanguageModel([], idf, np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32)).dump()
    number = {x: i for i, x in enumerate(languages)}
    x, target = [], []
    for i in range(0, len(rows), ROWS):
        some = rows[i : i + ROWS]
        row, feature, count, lettered = gram_counts([r["content"].decode("utf-8", "replace") for r in some])
        value = tf_idf(row, feature, count, idf, len(some))
        cuts = np.searchsorted(row, np.arange(len(some) + 1))
        for k in np.flatnonzero(lettered).tolist():
            x.append((feature[cuts[k] : cuts[k + 1]].astype(np.int32), value[cuts[k] : cuts[k + 1]]))
            target.append(number[some[k]["lang"]])
    target = np.array(target, dtype=np.int64)
    held = np.arange(len(x)) % 5 == 4
    if not len(x):
        return fit_rows([], idf)
    w, bias = fit_ftrl([r for r, h in zip(x, held, strict=True) if not h], target[~held], len(languages))
    logits = [value @ w[feature] + bias for (feature, value), h in zip(x, held, strict=True) if h]
    temperature = fit_temperature(np.array(logits).reshape(-1, len(languages)), target[held])
    return LanguageModel(languages, idf, w, bias, temperature).dump()


def identify(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: ``key``, held_out, lang_pred, score (calibrated probability of the predicted language).

    Only the text is looked at, whole. A text that is null or has no letter is ``und`` with score 0. Rows
    are independent, so repeated rows and ids just come again; other columns are ignored; an empty table
    gives an empty result.
    """
    key_type = docs.schema[key].dataType.simpleString()
    check = zlib.crc32(model)

    def run(batches):
        known = once(("language model", check), lambda: LanguageModel.load(model))
        for batch in batches:
            for a, b in pieces(batch.column(2), 1 << 19):
                rows = [x.decode("utf-8", "replace") for x in batch.column(2).slice(a, b - a).to_pylist()]
                names, scores = [], []
                for i in range(0, len(rows), ROWS):
                    name, score = known.predict(rows[i : i + ROWS])
                    names.extend(name)
                    scores.append(score)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), body(text).alias("content"))
    return rows.mapInArrow(give_back(run), f"doc_id {key_type}, held_out boolean, lang_pred string, score double").withColumnRenamed("doc_id", key)


def keep_identified(docs: DataFrame, model: bytes, min_score: float, text: str = "text") -> DataFrame:
    """The rows whose text has a language (is not ``und``) with a score of at least ``min_score``, with the columns they came with."""
    check, width = zlib.crc32(model), len(docs.columns)

    def run(batches):
        known = once(("language model", check), lambda: LanguageModel.load(model))
        for batch in batches:
            for a, b in pieces(batch.column(width), 1 << 19):
                part = batch.slice(a, b - a)
                rows = [x.decode("utf-8", "replace") for x in part.column(width).to_pylist()]
                keep = []
                for i in range(0, len(rows), ROWS):
                    names, scores = known.predict(rows[i : i + ROWS])
                    keep.extend(n != UNDETERMINED and s >= min_score for n, s in zip(names, scores.tolist(), strict=True))
                yield part.select(list(range(width))).filter(pa.array(keep, pa.bool_()))

    rows = docs.select(*docs.columns, body(text).alias("language_id_content"))
    return rows.mapInArrow(give_back(run), docs.schema)
