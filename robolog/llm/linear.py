"""Logistic regression on hashed features, fitted on a bounded sample in one task and applied everywhere.

A document is a bag of feature numbers, its vector their relative frequencies; fitting and scoring work
on flat arrays of feature numbers for many documents at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from robolog.llm.common import give_back, mix64

#: Log-odds are kept within this, so that a probability is never 0 or 1.
MOST_LOGIT = 30.0


class WordNumbers(dict):
    """Feature number of a word: its CRC-32 in ``bits`` bits; words met before are looked up."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        number = (zlib.crc32(word) * 0x9E3779B1 >> 7) & self.mask
        if len(word) <= 64:
            self[word] = number
        return number


def char_grams(text: bytes, n: int, bits: int) -> np.ndarray:
    """Feature numbers of all n-byte grams of a text (n up to 8)."""
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    if len(codes) < n:
        return np.zeros(0, dtype=np.int64)
    out = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = (out << np.uint64(8)) | codes[k : len(codes) - n + 1 + k]
    return (mix64(out) >> np.uint64(64 - bits)).astype(np.int64)


def bag_means(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean of each bag's values; 0 for an empty bag."""
    sums = np.add.reduceat(np.append(values, 0.0), np.minimum(np.cumsum(counts) - counts, len(values)))
    return np.where(counts > 0, sums, 0.0) / np.maximum(counts, 1)


class BagModel:
    """Weights of a binary logistic regression on several bags per document, and its calibration."""

    def __init__(self, widths: list[int]):
        self.weights = [np.zeros(w, dtype=np.float64) for w in widths]
        self.bias, self.slope, self.shift = 0.0, 1.0, 0.0

    def raw(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return self.bias + sum(bag_means(w[f], n) for w, (f, n) in zip(self.weights, bags, strict=True))

    def logit(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.clip(self.slope * self.raw(bags) + self.shift, -MOST_LOGIT, MOST_LOGIT)

    def probability(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.logit(bags)))

    def fit(self, docs: list[list[np.ndarray]], target: np.ndarray, weight: np.ndarray | None = None, rounds: int = 12, rate: float = 0.5, l2: float = 1e-6, batch: int = 64, seed: int = 0) -> BagModel:
        """Adagrad over ``rounds`` passes; ``docs`` holds each document's bags. Classes weigh alike."""
        weight = np.ones(len(target)) if weight is None else weight
        for y in (0, 1):
            own = weight[target == y].sum()
            weight = np.where(target == y, weight * (weight.sum() / (2 * own) if own else 1.0), weight)
        seen = [np.full(len(w), 1e-6) for w in self.weights]
        seen_bias, order = 1e-6, np.random.default_rng(seed)
        for _ in range(rounds):
            for some in np.array_split(order.permutation(len(target)), -(-len(target) // batch)):
                bags = stack([docs[i] for i in some], len(self.weights))
                p = 1.0 / (1.0 + np.exp(-np.clip(self.raw(bags), -MOST_LOGIT, MOST_LOGIT)))
                error = (p - target[some]) * weight[some] / len(some)
                seen_bias += error.sum() ** 2
                self.bias -= rate * error.sum() / np.sqrt(seen_bias)
                for w, s, (f, n) in zip(self.weights, seen, bags, strict=True):
                    numbers, at = np.unique(f, return_inverse=True)
                    grad = np.bincount(at, weights=np.repeat(error / np.maximum(n, 1), n), minlength=len(numbers)) + l2 * w[numbers]
                    s[numbers] += grad**2
                    w[numbers] -= rate * grad / np.sqrt(s[numbers])
        return self

    def calibrate(self, docs: list[list[np.ndarray]], target: np.ndarray, rounds: int = 50) -> BagModel:
        """Platt's scaling of the log-odds on documents that were not fitted (Newton steps, smoothed targets)."""
        return self.calibrate_raw(self.raw(stack(docs, len(self.weights))) if len(docs) else np.zeros(0), target, rounds)

    def calibrate_raw(self, x: np.ndarray, target: np.ndarray, rounds: int = 50) -> BagModel:
        """The same from their log-odds ``x`` before any scaling."""
        ones, zeros = target.sum(), len(target) - target.sum()
        if not ones or not zeros:
            return self
        goal = np.where(target == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        a, b = 1.0, 0.0
        for _ in range(rounds):
            p = 1.0 / (1.0 + np.exp(-np.clip(a * x + b, -MOST_LOGIT, MOST_LOGIT)))
            d, v = p - goal, np.maximum(p * (1 - p), 1e-6)
            g = np.array([(d * x).sum() + 1e-3 * (a - 1), d.sum()])
            h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
            step = np.linalg.solve(h + 1e-9 * np.eye(2), g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        if np.isfinite([a, b]).all() and a > 0:
            self.slope, self.shift = float(a), float(b)
        return self

    def dump(self) -> bytes:
        sizes = np.array([len(w) for w in self.weights], dtype=np.int64)
        head = np.array([self.bias, self.slope, self.shift], dtype=np.float64)
        return np.int64(len(sizes)).tobytes() + sizes.tobytes() + head.tobytes() + b"".join(w.astype(np.float32).tobytes() for w in self.weights)

    @staticmethod
    def load(data: bytes) -> BagModel:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8)
        at = 8 + 8 * n
        model = BagModel([0] * n)
        model.bias, model.slope, model.shift = map(float, np.frombuffer(data, np.float64, 3, at))
        at += 24
        for i, size in enumerate(sizes.tolist()):
            model.weights[i] = np.frombuffer(data, np.float32, size, at).astype(np.float64)
            at += 4 * size
        return model


def stack(docs: list[list[np.ndarray]], n_bags: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bags of many documents: for each kind, all feature numbers and their count per document."""
    out = []
    for k in range(n_bags):
        parts = [d[k] for d in docs]
        out.append((np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array([len(p) for p in parts], dtype=np.int64)))
    return out


def fit_in_one_task(sample: DataFrame, fit: Callable[[list[dict]], bytes]) -> bytes:
    """Run ``fit`` over the rows of a bounded sample in one task; the model comes to the driver (its size is fixed).

    The rows come in the order of the column ``sample_order``, so the model depends on the data alone.
    An empty sample gives what ``fit`` makes of no rows.
    """
    def run(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([fit(rows)], pa.binary())], ["model"])

    fitted = sample.repartition(1).sortWithinPartitions("sample_order").mapInArrow(give_back(run), "model binary").collect()
    return bytes(fitted[0]["model"]) if fitted else fit([])


def class_odds(labels: DataFrame, target: str) -> float:
    """How many rows are labelled 1 for one labelled 0, over the whole table (half a row is added to each)."""
    counts = {row[0]: row[1] for row in labels.where(F.col(target).isin(0, 1)).groupBy(F.col(target).cast("int")).count().collect()}
    return (counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)


def odds_shift(odds: float, target: np.ndarray) -> float:
    """What log-odds fitted on a sample with other class shares must be moved by to hold for the whole table."""
    ones = float((target == 1).sum())
    return float(np.log(odds * (len(target) - ones + 0.5) / (ones + 0.5)))


def labelled_sample(labels: DataFrame, docs: DataFrame, target: str, per_class: int, key: str, columns: list[str], seed: int = 7) -> DataFrame:
    """At most ``per_class`` documents of each class 0 and 1, chosen by a seeded hash of their id.

    The ids are bounded by 2 x ``per_class`` and small, hence broadcast to the documents; of rows that
    share an id the first by content is taken.
    """
    known = labels.select(F.col(key).alias("sample_id"), F.col(target).cast("int").alias("target")).where("sample_id IS NOT NULL AND target IN (0, 1)")
    known = known.groupBy("sample_id").agg(F.max("target").alias("target"))
    order = F.xxhash64(F.lit(seed), "sample_id")
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("target") == y).orderBy(order, "sample_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    found = docs.select(key, *columns).join(F.broadcast(chosen), F.col(key) == F.col("sample_id"))
    return found.select("target", *columns, F.xxhash64(F.lit(seed + 1), "sample_id", *columns).alias("sample_order"))
