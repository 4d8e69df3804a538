"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def body(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text, empty where it is null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b"").cast("binary"))


def ascii_lower(text: str | Column = "text") -> Column:
    """The text's bytes with A-Z lowered and every other byte as it is, valid UTF-8 or not; null counts as empty."""
    # In ISO-8859-1 every byte is a character, so nothing is replaced on the way there and back.
    return F.encode(F.translate(F.decode(body(text), "ISO-8859-1"), UPPER, UPPER.lower()), "ISO-8859-1")


def has_repeats(df: DataFrame, key: str) -> bool:
    """Whether some id stands in several rows. Only the ids are read."""
    return not df.groupBy(key).count().where("count > 1").isEmpty()


def once(key: object, build: Callable[[], object]) -> object:
    """What ``build`` gives, kept for the life of a Python worker (a tokenizer, a lookup table)."""
    held = sys.modules.setdefault("robolog_worker_state", types.ModuleType("robolog_worker_state")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def give_back(run: Callable) -> Callable:
    """A function over Arrow batches that hands freed memory back to the system when its task ends.

    Workers are reused by tasks of other stages, and what they no longer use would count against
    the executor as long as they live.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pieces(column: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of a binary column of about ``most`` bytes each; a longer value is a range of its own."""
    if not len(column):
        return
    ends = np.cumsum(np.asarray(pa.compute.binary_length(column).fill_null(0), dtype=np.int64))
    start, base = 0, 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)
