"""Token-id files: documents tokenised in the order of their ids, in framed, checksummed, range-coded blocks."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from robolog.llm.common import body, give_back, once, pieces, spread
from robolog.llm.token_coder import ID_BITS, decode_blocks, encode_blocks
from robolog.operators.scan import numbered
from robolog.session import scratch_path, write_once

#: Ids of a block, and blocks that are coded side by side.
BLOCK_IDS, LANES = 4096, 2048
#: What makes up fewer lanes than this is cut into smaller blocks, down to so many ids.
LEAST_LANES, LEAST_IDS = 256, 1024
#: Bytes of text that go into one file.
FILE_BYTES = 32 << 20
#: A frame: magic, ids, entries of the document table, code words, CRC-32 of the ids (as little-endian unsigned
#: 32-bit integers), CRC-32 of the document table. The table and the words follow, then a line feed.
HEAD = "<4sIIIII"
HEAD_SIZE = struct.calcsize(HEAD)
MAGIC, CONTINUES = b"RTB2", 1 << 31
#: Units a worker remembers; beyond that it forgets those it met in one batch only. Bytes of text looked up together.
KEPT_UNITS, BATCH_BYTES = 600_000, 4 << 20
NO_ID = -(1 << 63)

_CUT = re.compile(r"(?<=\S) (?=\S)")


class UnitTokenizer:
    """The tokenizers library, asked once for each unit of text it has met.

    A text is cut at single spaces between other characters, where this byte-level pre-tokenizer always
    begins a new piece, so the ids of the units make up the ids of the text. New units go through the library
    joined by single spaces; the ids of each begin at a token that begins with a space. Texts with a special
    token's string go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        if self.tokenizer.get_vocab_size() > 1 << ID_BITS:
            raise ValueError("more ids than the file format holds")
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token[0] == "\u0120"]] = True  # the byte-level sign for a space
        self.clear()

    def clear(self) -> None:
        self.index: dict = {}
        self.start, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.met = np.zeros(0, np.int32)  # batches in which a unit was met
        self._add([("", "end")], np.zeros(1, np.int32), np.ones(1, np.int64))

    def _forget(self) -> None:
        """Keep the units met in more than one batch, or nothing if that is not much less."""
        keep = np.flatnonzero(self.met > 1)
        if 2 * len(keep) > KEPT_UNITS or 2 * int(self.length[keep].sum()) > 16 * KEPT_UNITS:
            self.clear()
            return
        units = list(self.index)
        length, ids = self.length[keep], self.ids[spread(self.start[keep], self.length[keep])]
        self.clear()
        units = [units[k] for k in keep.tolist()]
        self._add(units, ids, length)

    def _units(self, text: str) -> list:
        if not text:
            return []
        if any(x in text for x in self.special):
            return [(text,)]
        units = _CUT.split(text)
        units[0] = (units[0],)  # the first unit has no space before it
        return units

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by id 0, and the number of ids of each (with that one)."""
        if len(self.index) > KEPT_UNITS or len(self.ids) > 16 * KEPT_UNITS:
            self._forget()
        plain = np.array([bool(t) and not any(x in t for x in self.special) for t in texts], dtype=bool)
        counts = np.ones(len(texts), dtype=np.int64)
        parts = []
        if plain.any():
            lists = pc.split_pattern(pa.array([t for t, p in zip(texts, plain.tolist(), strict=True) if p], pa.large_string()), " ")
            offsets = np.asarray(lists.offsets, dtype=np.int64)
            coded = lists.values.dictionary_encode()
            units, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(coded.indices)
            # Texts with a space beside another one, or beside the text's end, are cut with more care.
            bare = np.fromiter((not u or u.strip() != u for u in units), dtype=bool, count=len(units))
            if bare.any():
                kept = ~np.logical_or.reduceat(bare[at], offsets[:-1])
                plain[plain] = kept
                at, wide = at[np.repeat(kept, np.diff(offsets))], np.diff(offsets)[kept]
                offsets = np.append(0, np.cumsum(wide))
                known, at = np.unique(at, return_inverse=True)
                units = [units[k] for k in known.tolist()]
            first, which = np.unique(at[offsets[:-1]], return_inverse=True)
            found = self._numbers([*units, *((units[k],) for k in first.tolist())])
            at = found[at]
            at[offsets[:-1]] = found[len(units) + which]
            counts[plain] += np.diff(offsets)
            parts.append((plain, at))
        if not plain.all():
            own = [self._units(t) for t, p in zip(texts, plain.tolist(), strict=True) if not p]
            counts[~plain] += np.fromiter(map(len, own), dtype=np.int64, count=len(own))
            flat = [u for units in own for u in units]
            order = {u: k for k, u in enumerate(dict.fromkeys(flat))}
            parts.append((~plain, self._numbers(list(order))[[order[u] for u in flat]] if flat else np.zeros(0, np.int64)))
        begin = np.cumsum(counts) - counts
        placed = np.zeros(int(counts.sum()), dtype=np.int64)  # unit 0 is the end of a text
        for which, at in parts:
            placed[spread(begin[which], counts[which] - 1)] = at
        length = self.length[placed]
        upto = np.cumsum(np.append(0, length))[np.append(begin, len(placed))]
        return self.ids[spread(self.start[placed], length)], np.diff(upto)

    def _numbers(self, units: list) -> np.ndarray:
        """The number of each of different units; those not met yet are tokenised."""
        found = np.fromiter(map(self.index.get, units, repeat(-1)), dtype=np.int64, count=len(units))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = [units[k] for k in missing]
            self._learn(new)
            found[missing] = list(map(self.index.__getitem__, new))
        self.met[found] += 1
        return found

    def _learn(self, new: list) -> None:
        joined, alone = [], []
        for u in new:
            (joined if type(u) is not tuple and u and " " not in u and u.strip() == u else alone).append(u)
        units, ids, lengths = [], [], []
        for k in range(0, len(joined), 1000):
            some = joined[k : k + 1000]
            text = " " + " ".join(some)
            found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)
            begin = np.flatnonzero(self.begins[found])
            if len(begin) == len(some) and not any(x in text for x in self.special):
                units.extend(some)
                ids.append(found)
                lengths.append(np.diff(np.append(begin, len(found))))
            else:
                alone.extend(some)
        if alone:
            found = [x.ids for x in self.tokenizer.encode_batch_fast([u[0] if type(u) is tuple else " " + u for u in alone], add_special_tokens=False)]
            units.extend(alone)
            lengths.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
            ids.append(np.fromiter((i for x in found for i in x), dtype=np.int32, count=int(lengths[-1].sum())))
        self._add(units, np.concatenate(ids), np.concatenate(lengths))

    def _add(self, units: list, ids: np.ndarray, length: np.ndarray) -> None:
        base = len(self.start)
        self.index.update(zip(units, range(base, base + len(units)), strict=True))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(length) - length)
        self.length, self.ids = np.append(self.length, length), np.append(self.ids, ids)
        self.met = np.append(self.met, np.zeros(len(units), np.int32))


def _frames(doc: np.ndarray, counts: np.ndarray, ids: np.ndarray, goes_on: np.ndarray, block_ids: int) -> Iterator[bytes]:
    """Frames of the ids of documents in their order; ``goes_on``: the document's ids continue in what comes later."""
    ends = np.cumsum(counts)
    block_ids = max(min(block_ids, LEAST_IDS), min(block_ids, -(-len(ids) // LEAST_LANES)))
    cuts = np.arange(0, len(ids), block_ids)
    blocks = [ids[c : c + block_ids] for c in cuts.tolist()]
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    words: list = [None] * len(blocks)
    for k, w in zip(order.tolist(), encode_blocks([blocks[k] for k in order.tolist()]), strict=True):
        words[k] = w
    for c, block, word in zip(cuts.tolist(), blocks, words, strict=True):
        stop = c + len(block)
        a, b = int(np.searchsorted(ends, c, side="right")), int(np.searchsorted(ends, stop, side="left")) + 1
        own = np.minimum(ends[a:b], stop) - np.maximum(ends[a:b] - counts[a:b], c)
        more = (ends[a:b] > stop) | ((ends[a:b] == stop) & goes_on[a:b])
        table = doc[a:b].astype("<i8").tobytes() + (own.astype("<u4") | np.where(more, CONTINUES, 0).astype("<u4")).tobytes()
        plain = block.astype("<u4").tobytes()
        yield struct.pack(HEAD, MAGIC, len(block), b - a, len(word), zlib.crc32(plain), zlib.crc32(table)) + table + word.astype("<u2").tobytes()


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES, block_ids: int = BLOCK_IDS, lanes: int = LANES) -> None:
    """Tokenise whole texts (null: empty), end each with id 0, and write files below ``path`` in ascending order of ids.

    Documents are range-partitioned by id, a partition of about ``file_bytes`` of text is a file, and the files'
    names are in that order; a null id comes first, repeated rows each are written. ``lanes`` blocks are held
    at a time. ids must be whole numbers.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), body(text).alias("content"))
    size = rows.agg(F.sum(F.octet_length("content") + 64)).first()[0] or 0
    files = max(-(-size // file_bytes), min(docs.sparkSession.sparkContext.defaultParallelism, -(-size // (1 << 20))), 1)
    group = block_ids * lanes

    def run(batches):
        coder = once(("units", tokenizer_path), lambda: UnitTokenizer(tokenizer_path))
        doc, counts, ids, held = [], [], [], 0

        def flush(last: bool):
            """Frames of whole groups; what is left over waits for more."""
            nonlocal doc, counts, ids, held
            d, c, i = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, counts, ids))
            while len(i) and (last or len(i) >= group):
                n = min(group, len(i))
                ends = np.cumsum(c)
                k = int(np.searchsorted(ends, n, side="left"))
                own = c[: k + 1].copy()
                own[k] -= ends[k] - n
                goes_on = np.zeros(k + 1, dtype=bool)
                goes_on[k] = ends[k] > n
                frames = list(_frames(d[: k + 1], own, i[:n], goes_on, block_ids))
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
                rest = c[k] - own[k]
                d, c, i = (d[k:], np.append(rest, c[k + 1 :]), i[n:]) if rest else (d[k + 1 :], c[k + 1 :], i[n:])
            doc, counts, ids, held = [d], [c], [i], len(i)

        for batch in batches:
            number = np.asarray(batch.column(0).fill_null(NO_ID))
            for a, b in pieces(batch.column(1), BATCH_BYTES):
                found, n = coder.encode([x.decode("utf-8", "replace") for x in batch.column(1).slice(a, b - a).to_pylist()])
                doc.append(number[a:b])
                counts.append(n)
                ids.append(found)
                held += len(found)
                if held >= group:
                    yield from flush(False)
        yield from flush(True)

    # Rows of one id, or without one, are split as well: by content, and by their number where that is the same.
    order = ["doc", "__content", "__row"]
    told = rows.withColumns({"__content": F.xxhash64("content"), "__row": F.monotonically_increasing_id()})
    ordered = told.repartitionByRange(int(files), *order).sortWithinPartitions(*order).drop("__content", "__row")
    frames = ordered.mapInArrow(give_back(run), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)


def _read_frames(content: bytes) -> Iterator[tuple]:
    """doc, counts, continues, number of ids, words and checksum of each frame of a file."""
    at = 0
    while at < len(content):
        magic, n, entries, n_words, check, table_check = struct.unpack_from(HEAD, content, at)
        table = content[at + HEAD_SIZE : at + HEAD_SIZE + 12 * entries]
        if magic != MAGIC or zlib.crc32(table) != table_check:
            raise ValueError("not a token file, or a damaged one")
        own = np.frombuffer(table, "<u4", entries, 8 * entries)
        at += HEAD_SIZE + 12 * entries
        yield np.frombuffer(table, "<i8", entries), (own & (CONTINUES - 1)).astype(np.int64), own >= CONTINUES, n, np.frombuffer(content, "<u2", n_words, at), check
        at += 2 * n_words + 1


def _documents(content: bytes, lanes: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Documents of a file in their order: id, and its ids in parts."""
    held: list[np.ndarray] = []
    group: list[tuple] = []

    def decoded():
        order = np.argsort([-x[3] for x in group], kind="stable").tolist()
        out: list = [None] * len(group)
        for k, ids in zip(order, decode_blocks([group[k][4] for k in order], np.array([group[k][3] for k in order], dtype=np.int64)), strict=True):
            out[k] = ids
        for (doc, counts, more, _, _, check), ids in zip(group, out, strict=True):
            if zlib.crc32(ids.astype("<u4").tobytes()) != check:
                raise ValueError("a block does not match its checksum")
            at = 0
            for d, c, m in zip(doc.tolist(), counts.tolist(), more.tolist(), strict=True):
                held.append(ids[at : at + c])
                at += c
                if not m:
                    yield d, list(held)
                    held.clear()

    for frame in _read_frames(content):
        group.append(frame)
        if len(group) == lanes:
            yield from decoded()
            group = []
    if group:
        yield from decoded()
    if held:
        raise ValueError("the file ends inside a document")


def read_token_files(spark: SparkSession, path: str, digests: bool = False, lanes: int = LANES) -> DataFrame:
    """One row per document of the files: file, place (its number in the file), doc_id, n_tokens, then ids, or with
    ``digests`` ids_crc32. Every block is checked against its checksum; a damaged file fails the read."""
    def run(batches):
        for batch in batches:
            for name, content in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                rows = []
                for place, (doc, parts) in enumerate(_documents(content, lanes)):
                    if digests:
                        value = 0
                        for x in parts:
                            value = zlib.crc32(x.astype("<u4").tobytes(), value)
                    else:
                        value = np.concatenate(parts)
                    rows.append((name, place, None if doc == NO_ID else doc, sum(map(len, parts)), value))
                    if len(rows) == 2000:
                        yield _batch(rows, digests)
                        rows = []
                if rows:
                    yield _batch(rows, digests)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    last = "ids_crc32 bigint" if digests else "ids array<int>"
    return files.mapInArrow(give_back(run), f"file string, place bigint, doc_id bigint, n_tokens bigint, {last}")


def _batch(rows: list[tuple], digests: bool) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64() if digests else pa.list_(pa.int32())]
    arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["file", "place", "doc_id", "n_tokens", "ids_crc32" if digests else "ids"])


def part_number(file: Column) -> Column:
    """The number in a file's name; as text, part-100000 would come before part-10001."""
    return F.regexp_extract(file, r"part-(\d+)[^/]*$", 1).cast("bigint")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the files.

    Starts are added up over the files (one row for each, in the order of the numbers in their names), then
    within a file over its documents.
    """
    rows = write_once(read_token_files(spark, path, digests=True))
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total")).withColumn("part", part_number(F.col("file")))
    files = numbered(files, "part", "__no", base="total").select("file", F.col("base").cast("bigint").alias("base"))
    within = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(files, "file").withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0).cast("bigint")))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")


def tokenize_to_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write the token files of ``docs`` (below the shared folder unless ``path`` is given) and index them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_path, **options)
    return token_index(spark, path)
