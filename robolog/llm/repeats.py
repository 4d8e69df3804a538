"""Repeated passages: bytes of windows that also start earlier are found with run-compressed indexes and removed."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from robolog.llm.anchors import runs
from robolog.llm.common import body, give_back, mix64, pieces
from robolog.llm.run_index import MOST_SYMBOLS, earlier_windows
from robolog.operators.joins import side_join
from robolog.operators.scan import row_number, scan
from robolog.session import materialize, write_once

#: Bytes of a window.
LENGTH = 100
#: The key of a window is the smallest hash of its grams. They are this much shorter than the window; where a key has too many
#: different runs for one index, the runs are cut again by longer grams. A gram of the last kind is the window itself.
SHORTER = (52, 28, 12, 4, 1, 0)
#: Bytes of all runs of one key up to which they are indexed together.
INDEX_BYTES = MOST_SYMBOLS - (1 << 18)
#: Runs that a task holds back to merge equal ones before the shuffle.
HELD_RUNS = 1 << 20
#: Bytes of a document that are hashed at once; longer ones are cut with an overlap of a window.
PART_BYTES = 1 << 21
#: Texts without an id are numbered from the first of these; all below the second are theirs.
NO_ID, FIRST_ID = -(1 << 62), -(1 << 62) + (1 << 60)


def _numbered(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int, bool]:
    """doc, content: ids as whole numbers in the order of documents; by how much they were stretched; whether rows repeat them.

    A null id comes first. Where several different texts have one id, ids are multiplied to make room and
    these texts follow each other by a 128-bit hash; rows that repeat id and text are one document.
    Only ids and hashes are ordered, and :func:`scan` cuts an id that very many rows have.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("doc"), body(text).alias("content"))
    if rows.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return rows, 1, False
    hashed = rows.select("*", F.xxhash64("content").alias("h1"), F.xxhash64(F.lit(1), "content").alias("h2"))
    texts = materialize(hashed.select("doc", "h1", "h2").distinct())
    later = materialize(scan(texts, ["doc"], ["h1", "h2"], rank=row_number()).where("rank > 1"))
    most = later.where(F.col("doc") != NO_ID).agg(F.max("rank")).first()[0] or 1
    rank = F.coalesce(F.col("rank") - 1, F.lit(0).cast("bigint"))
    number = F.when(F.col("doc") == NO_ID, F.col("doc") + rank).otherwise(F.col("doc") * most + rank)
    return write_once(side_join(hashed, later, ["doc", "h1", "h2"]).select(number.alias("doc"), "content")), most, True


def _cut(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row numbers, offsets and texts, long texts in parts that overlap by all but one byte of a window."""
    if all(len(x) <= PART_BYTES for x in texts):
        return np.arange(len(texts)), np.zeros(len(texts), dtype=np.int64), texts
    rows, offsets, parts = [], [], []
    for row, x in enumerate(texts):
        for at in range(0, max(1, len(x) - length + 1), PART_BYTES):
            rows.append(row)
            offsets.append(at)
            parts.append(x[at : at + PART_BYTES + length - 1])
    return np.array(rows, dtype=np.int64), np.array(offsets, dtype=np.int64), parts


def _table(key, print_, doc, start, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, print_, pa.array(doc), pa.array(start), pa.array(place)], ["key", "print", "doc", "start", "place"])


def _known(doc, start, size) -> pa.RecordBatch:
    """Stretches that repeat for certain: they have no key."""
    none = pa.nulls(len(doc), pa.int64())
    return _table(none, none, doc, start, size << 1)


def _merged(held: list[list[np.ndarray]]):
    """Of equal runs the first is sent on under its key; the others are repeats for certain and have no key."""
    key, print_, doc, start, place = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((start, doc, print_, key))
    key, print_, doc, start, place = key[order], print_[order], doc[order], start[order], place[order]
    new = np.append(True, (key[1:] != key[:-1]) | (print_[1:] != print_[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    again = (doc != doc[first]) | (start != start[first])
    for at in np.array_split(np.flatnonzero(new), -(-int(new.sum()) // 100_000)):
        yield _table(pa.array(key[at]), pa.array(print_[at]), doc[at], start[at], place[at])
    rest = np.flatnonzero(again)
    if len(rest):
        # Neighbouring repeats become one stretch.
        rest = rest[np.lexsort((start[rest], doc[rest]))]
        doc, start, stop = doc[rest], start[rest], start[rest] + (place[rest] >> 1)
        new = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1]))
        head = np.flatnonzero(new)
        stop = np.maximum.reduceat(stop, head)
        yield _known(doc[head], start[head], stop - start[head])


def anchored_runs(rows: DataFrame, length: int, gram: int, held_runs: int = HELD_RUNS) -> DataFrame:
    """key, print, doc, start, place (size << 1 | whether equal windows may be inside) of every run of windows.

    ``rows`` are doc, content, where in the document that starts, and the key that all its windows have so far
    (0: none); equal windows have equal keys before and after. Rows without a key are stretches already known
    to repeat. Where a gram is a whole window, a run is many times the same window: all but the first repeat.
    """
    def run(batches):
        held, size = [], 0
        for batch in batches:
            doc, from_, key = (np.asarray(batch.column(i)) for i in (0, 2, 3))
            for a, b in pieces(batch.column(1), 1 << 20):
                row, offset, texts = _cut(batch.column(1).slice(a, b - a).to_pylist(), length)
                number, offset, parent = doc[a:b][row], offset + from_[a:b][row], mix64(key[a:b][row].astype(np.uint64)).view(np.int64)
                for c, d in _ranges(texts):
                    found = runs(texts[c:d], length, gram)
                    if not len(found["key"]):
                        continue
                    own = found["text"] + c
                    start, place = found["start"] + offset[own], (found["stop"] - found["start"]) << 1 | found["inner"]
                    if gram == length:
                        more = np.flatnonzero(place >> 1 > length)
                        if len(more):
                            yield _known(number[own[more]], start[more] + 1, (place[more] >> 1) - 1)
                        place = np.full(len(own), length << 1, dtype=np.int64)
                    held.append([found["key"] ^ parent[own], found["print"], number[own], start, place])
                    size += len(own)
                if size >= held_runs:
                    yield from _merged(held)
                    held, size = [], 0
        if held:
            yield from _merged(held)

    return rows.mapInArrow(give_back(run), "key bigint, print bigint, doc bigint, start bigint, place bigint")


def _ranges(texts: list[bytes]):
    start, size = 0, 0
    for i, x in enumerate(texts):
        if size and size + len(x) > PART_BYTES:
            yield start, i
            start, size = i, 0
        size += len(x)
    if texts:
        yield start, len(texts)


def _marked(batches):
    """From runs sorted by key, print, doc and start: repeats (key null) and, where a key has several different
    runs, the first of each (with its key). One row is carried from batch to batch, so a key may have any number."""
    carry, distinct_before, waits, inner_before = None, 0, False, False
    for batch in batches:
        columns = [batch.column(i) for i in range(5)]
        known = np.asarray(columns[0].is_valid())
        if not known.all():
            done = batch.filter(pa.array(~known))
            yield pa.RecordBatch.from_arrays([done.column(0), done.column(2), done.column(3), pa.compute.add(done.column(3), pa.compute.shift_right(done.column(4), 1))], ["key", "doc", "start", "stop"])
            batch = batch.filter(pa.array(known))
        if not batch.num_rows:
            continue
        rows = [np.asarray(batch.column(i)) for i in range(5)]
        if carry is not None:
            rows = [np.append(c, r) for c, r in zip(carry, rows, strict=True)]
        key, print_, doc, start, place = rows
        new_key = np.append(True, key[1:] != key[:-1])
        new = new_key | np.append(True, print_[1:] != print_[:-1])
        group = np.cumsum(new_key) - 1
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        again = (doc != doc[first]) | (start != start[first])
        distinct = np.bincount(group, weights=new).astype(np.int64)
        inner = np.bincount(group, weights=new & (place & 1 == 1)) > 0
        if carry is not None:
            distinct[0] += distinct_before - 1
            inner[0] |= inner_before
        several = (distinct > 1) | inner
        sent = new & several[group]
        if carry is not None and not waits:
            sent[0] = False
        at = np.flatnonzero(again | sent)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at], mask=again[at]), pa.array(doc[at]), pa.array(start[at]), pa.array(start[at] + (place[at] >> 1))],
                ["key", "doc", "start", "stop"],
            )
        carry = [r[first[-1] : first[-1] + 1] for r in rows]
        distinct_before, inner_before, waits = int(distinct[-1]), bool(inner[-1]), not several[-1]


def _indexed(length: int):
    """From run texts sorted by key, doc and start: the stretches of windows that also start earlier."""
    def stretches(rows: list[tuple]):
        doc, start, stop = [], [], []
        for (_, d, s, _), hit in zip(rows, earlier_windows([r[3] for r in rows], length), strict=True):
            if len(hit):
                head = np.flatnonzero(np.append(True, np.diff(hit) > 1))
                doc.append(np.full(len(head), d, dtype=np.int64))
                start.append(hit[head] + s)
                stop.append(hit[np.append(head[1:], len(hit)) - 1] + s + length)
        if doc:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (doc, start, stop)], ["doc", "start", "stop"])

    def run(batches):
        ready, ready_size, group, group_size = [], 0, [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if group and row[0] != group[-1][0]:
                    if ready_size + group_size > MOST_SYMBOLS:
                        yield from stretches(ready)
                        ready, ready_size = [], 0
                    ready.extend(group)
                    ready_size += group_size
                    group, group_size = [], 0
                group.append(row)
                group_size += len(row[3]) + 1
        if ready_size + group_size > MOST_SYMBOLS:
            yield from stretches(ready)
            ready = []
        if ready or group:
            yield from stretches(ready + group)

    return run


def repeated_stretches(rows: DataFrame, length: int = LENGTH, index_bytes: int = INDEX_BYTES, held_runs: int = HELD_RUNS) -> DataFrame:
    """doc, start, stop: stretches (they may overlap) that cover exactly the bytes of windows that also start earlier.

    Also ``gram`` and ``path`` (equal, index): at which length of grams, and how, the stretch was found. ``rows`` has
    doc (distinct, in the order that counts as earlier) and content. Windows are grouped into runs by the
    smallest gram hash inside them; equal windows share that key, so only runs of one key are compared. Equal
    runs need no comparing: all but the first repeat. What differs under one key is put into run-compressed
    indexes of a bounded size and streamed through them. The runs of a key that exceeds that size are cut again
    by the smallest hash of longer grams, until each key fits: with grams one byte shorter than a window
    a key holds runs of two windows at most, and with grams as long as a window it holds one window.
    """
    parts = rows.select("doc", "content", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("key"))
    out = []
    for gram in (length - x for x in SHORTER):
        found = anchored_runs(parts, length, gram, held_runs)
        dealt = found.repartition(F.coalesce("key", F.xxhash64("doc", "start"))).sortWithinPartitions("key", "print", "doc", "start")
        marked = write_once(dealt.mapInArrow(give_back(_marked), "key bigint, doc bigint, start bigint, stop bigint"))
        mixed = marked.where("key IS NOT NULL")
        # Where a gram is a window, what differs under one key are two windows of one hash: always few.
        large = materialize(mixed.groupBy("key").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("size")).where(F.col("size") > index_bytes).select("key")) if gram < length else None
        any_large = large is not None and not large.isEmpty()
        small = side_join(mixed, large, ["key"], "left_anti") if any_large else mixed
        indexed = _snippets(rows, small).repartition("key").sortWithinPartitions("key", "doc", "start").mapInArrow(give_back(_indexed(length)), "doc bigint, start bigint, stop bigint")
        way = lambda name: [F.lit(gram).alias("gram"), F.lit(name).alias("path")]  # noqa: B023, E731
        out += [marked.where("key IS NULL").select("doc", "start", "stop", *way("equal")), indexed.select("*", *way("index"))]
        if not any_large:
            break
        # Few documents hold such keys: only their texts are moved, and their runs are written once.
        crowded = materialize(side_join(mixed, large, ["key"], "left_semi"))
        held = side_join(rows, crowded.select("doc").distinct(), ["doc"], "left_semi")
        parts = write_once(_snippets(held, crowded)).select("doc", "content", "start", "key")
    return reduce(DataFrame.unionByName, out)


def _snippets(rows: DataFrame, runs_: DataFrame) -> DataFrame:
    """The bytes of runs: key, doc, start, content."""
    own = F.expr("substring(content, CAST(start + 1 AS INT), CAST(stop - start AS INT))")
    return rows.join(runs_, "doc").select("key", "doc", "start", own.alias("content"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, digests: bool = False, **sizes: int) -> DataFrame:
    """One row per row: ``key`` (bigint), n_bytes, n_removed, n_spans, spans (start and stop of each removed run) and kept (binary).

    Removed is every byte covered by ``length`` bytes that also start earlier: in a document of smaller id, or
    further to the front of the same one, judged on the input; matches never cross documents. A null text is
    empty; a null id comes before all others; rows that repeat id and text are one document and get equal
    results; different texts of one id follow each other by a hash of their bytes. ids must be whole numbers. Other columns
    are ignored; an empty table gives an empty result. With ``digests`` kept_sha256 (of the remaining bytes)
    takes the place of spans and kept. Cuts may fall inside a character, hence the remaining bytes are binary.
    """
    rows, most, repeated = _numbered(docs, key, text)
    stretches = repeated_stretches(write_once(rows.dropDuplicates(["doc"])) if repeated else rows, length, **sizes)
    per_doc = stretches.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("stretches"))
    joined = rows.join(per_doc, "doc", "left").select("doc", "content", "stretches.start", "stretches.stop")

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                part = batch.slice(a, b - a)
                out = [_without(*row) for row in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
                numbers = [pa.array([len(t) for t in part.column(1).to_pylist()], pa.int64()), pa.array([sum(t - s for s, t in x[0]) for x in out], pa.int64()), pa.array([len(x[0]) for x in out], pa.int64())]
                if digests:
                    rest = [pa.array([hashlib.sha256(x[1]).hexdigest() for x in out], pa.string())]
                else:
                    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                    rest = [pa.array([[{"start": s, "stop": t} for s, t in x[0]] for x in out], kind), pa.array([x[1] for x in out], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, *rest], ["doc", "n_bytes", "n_removed", "n_spans", *(["kept_sha256"] if digests else ["spans", "kept"])])

    last = "kept_sha256 string" if digests else "spans array<struct<start:bigint,stop:bigint>>, kept binary"
    done = joined.mapInArrow(give_back(run), f"doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {last}")
    own = F.when(F.col("doc") >= FIRST_ID, F.expr(f"(doc - pmod(doc, {most}L)) div {most}L"))
    return done.withColumn("doc", own).withColumnRenamed("doc", key)


def _without(content: bytes, starts: list | None, stops: list | None) -> tuple[list[tuple[int, int]], bytes]:
    """Disjoint removed runs and the bytes that remain."""
    if not starts:
        return [], content
    spans: list[list[int]] = []
    for s, t in sorted(zip(starts, stops, strict=True)):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], t)
        else:
            spans.append([s, t])
    kept, at = [], 0
    for s, t in spans:
        kept.append(content[at:s])
        at = t
    return [tuple(x) for x in spans], b"".join([*kept, content[at:]])
