"""Exact deduplication: Grace hash partitioning and open-addressing tables that compare whole contents."""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from robolog.llm.common import ascii_lower, body, give_back, has_repeats

#: Bytes of distinct content a table holds before its bucket is partitioned again.
TABLE_BYTES = 64 << 20
FAN_OUT = 16


class ContentTable:
    """Open addressing with linear probing; a slot is a hit only if the whole content is equal."""

    def __init__(self, slots: int = 1024):
        self.slots = np.full(slots, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.rows: list[list] = []  # digest, content, largest id, count
        self.size = 0

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        slots = np.full(mask + 1, -1, dtype=np.int64)
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = entry
        self.slots = slots

    def add(self, digest: bytes, content: bytes, key, count: int) -> None:
        h, mask = int.from_bytes(digest[-8:], "little"), len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            row = self.rows[entry]
            if self.hashes[entry] == h and row[1] == content:
                row[2] = key if row[2] is None or (key is not None and key > row[2]) else row[2]
                row[3] += count
                return
            if self.hashes[entry] == h and row[0] == digest:
                raise ValueError(f"two contents share the digest {digest.hex()}")
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.hashes.append(h)
        self.rows.append([digest, content, key, count])
        self.size += len(content)
        if 2 * len(self.rows) > len(self.slots):
            self._grow()


def grace(records: Iterable[tuple], most: int, depth: int = 0) -> Iterator[list]:
    """One (digest, content, largest id, count) per distinct content of a bucket.

    A bucket whose distinct contents exceed ``most`` bytes is split by the next four bits of the
    digest into spill files, and each is treated in turn. The files have no name: the system removes
    them when the task ends, however it ends, and a lost executor's task starts again elsewhere.
    """
    table, files = ContentTable(), None
    for record in records:
        if files is not None:
            pickle.dump(record, files[_digit(record[0], depth)], protocol=5)
            continue
        table.add(*record)
        if table.size > most and len(table.rows) > 1 and depth < 48:
            files = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
            for row in table.rows:
                pickle.dump(tuple(row), files[_digit(row[0], depth)], protocol=5)
            table = None
    if files is None:
        yield from table.rows
        return
    for file in files:
        file.seek(0)
        with file:
            yield from grace(_reread(file), most, depth + 1)


def _digit(digest: bytes, depth: int) -> int:
    return (digest[depth // 2] >> (4 * (depth % 2))) & 15


def _reread(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _records(batch: pa.RecordBatch) -> Iterator[tuple]:
    for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        content = content.lower()  # bytes: A-Z only
        yield hashlib.sha256(content).digest(), content, key, 1


def _batches(rows: Iterator[list], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 100
        if size > most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    by_name = dict(zip(("digest", "content", "keep_id", "n"), zip(*rows, strict=True), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(by_name[f.name], f.type) for f in schema], schema=schema)


def content_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct content: ``digest`` (binary SHA-256), ``keep_id`` (largest id), ``group_size``.

    Copies are first merged batch by batch where they are read, so however many copies a content has,
    each batch sends it once. The exchange on the digest is the first partitioning into buckets; a task
    whose bucket does not fit a table goes on partitioning it (:func:`grace`). Equality is that of the
    whole normalised content; should two contents ever share a digest, the run fails.
    """
    id_type = docs.schema[key].dataType
    kind = pa.from_numpy_dtype(np.int64) if id_type.typeName() == "long" else None
    rows = docs.select(F.col(key).alias("doc_id"), body(text).alias("content"))

    def first(batches):
        for batch in batches:
            schema = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("keep_id", kind or batch.schema.field(0).type), ("n", pa.int64())])
            yield from _batches(grace(_records(batch), table_bytes), schema)

    def last(batches):
        held: list = []

        def records():
            for batch in batches:
                held[:] = [batch.schema.field(2).type]
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

        out = []
        for row in grace(records(), table_bytes):
            out.append((row[0], row[2], row[3]))
            if len(out) == 50_000:
                yield _named(out, held[0])
                out = []
        if out:
            yield _named(out, held[0])

    schema = f"digest binary, content binary, keep_id {id_type.simpleString()}, n bigint"
    local = rows.mapInArrow(give_back(first), schema)
    return local.repartition("digest").mapInArrow(give_back(last), f"digest binary, keep_id {id_type.simpleString()}, group_size bigint")


def _named(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    digest, keep, size = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(keep, kind), pa.array(size, pa.int64())], ["digest", "keep_id", "group_size"])


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with the largest id
    stays. A null text counts as empty. Of rows repeated with the same id and text one stays. A null id
    is smaller than any other. Other columns are ignored, an empty table gives an empty result.
    """
    id_type = docs.schema[key].dataType.simpleString()

    def digests(batches):
        for batch in batches:
            found = [hashlib.sha256(x.lower()).digest() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

    members = (
        docs.select(F.col(key).alias("doc_id"), body(text).alias("content"))
        .mapInArrow(give_back(digests), f"doc_id {id_type}, digest binary")
        .groupBy("doc_id", "digest")
        .agg(F.count("*").alias("n"))
    )
    groups = content_groups(docs, key, text, table_bytes)
    found = members.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    return found.select(
        F.col("doc_id").alias(key), "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
    )


def drop_exact(docs: DataFrame, key: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    groups = content_groups(docs, key, text, table_bytes).select(
        F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep_id"))
    marked = docs.withColumn("__digest", F.unhex(F.sha2(ascii_lower(text), 256)))
    kept = marked.join(
        groups.withColumnRenamed("__digest", "__d"),
        (F.col("__digest") == F.col("__d")) & F.col(key).eqNullSafe(F.col("__keep_id")),
    )
    # Only where an id stands in several rows can a row repeat.
    kept = kept.dropDuplicates(["__digest", key]) if has_repeats(docs, key) else kept
    return kept.select(*docs.columns)
