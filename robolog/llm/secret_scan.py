"""Secret scan: fixed patterns, and strings whose sliding-window entropy is high for their character class."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from robolog.llm.common import body, give_back, pieces

KINDS = ("assign", "access", "hex", "entropy")
# The patterns of the base kinds. A too short match is dropped and not searched again.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched whole or not at all, so this drops the short ones
LEAST_ASSIGN, LEAST_ACCESS = 8, 16


@dataclass(frozen=True)
class CharClass:
    """A run of ``chars`` is suspect where a window of it has at least ``bits`` of entropy a character and a member of each of ``needs``."""

    chars: str
    window: int
    bits: float
    needs: tuple[str, ...]


CLASSES = (
    CharClass("0-9A-Fa-f", 32, 3.0, ("0-9", "A-Fa-f")),
    CharClass("A-Za-z0-9+/_=-", 20, 3.75, ("0-9", "A-Z", "a-z")),
)
#: Whole candidate strings that are no secrets: identifiers, digests of published files, words and numbers put together, stand-ins.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}",
    r"sha(?:256|384|512)-[A-Za-z0-9+/=]+",
    r"[/_=+-]*(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+|[0-9]{1,4})(?:[/_=+-]+(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+|[0-9]{1,4}))*[/_=+-]*",
    r"(?i).*(?:example|placeholder|change_?me|dummy|your[_-]).*",
)
#: Alphabets in order: what stands in one of them is no secret either.
ALPHABETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdefABCDEF", "0123456789ABCDEFabcdef")
#: Entropy in whole numbers of this share of a bit, so that sums do not depend on where they begin.
UNIT = 1 << 32
#: Characters of a candidate treated at once; the windows across the cut are treated with both sides.
BLOCK = 1 << 20
# Every text with a span has a place like this.
_HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9A-Fa-f]{32}|[A-Za-z0-9+/_=-]{20}"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and without overlap within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def _gains(window: int) -> np.ndarray:
    """What one more of a symbol adds to the sum of c log2 c when there are k of it."""
    c = np.arange(window + 1, dtype=np.float64)
    weight = c * np.log2(np.maximum(c, 1))
    return np.rint(np.diff(weight) * UNIT).astype(np.int64)


def _equal_near(symbols: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of the window - 1 symbols before each one, and after it, are the same."""
    before, after = np.zeros(len(symbols), dtype=np.int64), np.zeros(len(symbols), dtype=np.int64)
    for d in range(1, min(window, len(symbols))):
        same = symbols[d:] == symbols[:-d]
        before[d:] += same
        after[:-d] += same
    return before, after


def suspect_windows(strings: list[bytes], kind: CharClass) -> list[np.ndarray]:
    """The places of each string where a suspect window begins.

    The sum of c log2 c moves with the window: a symbol that comes in adds by how many of it are there, the
    one that goes out takes away likewise. All strings are run through at once; a symbol is told apart by
    its string, so that no count reaches over an edge. Strings are at least a window long.
    """
    if not strings:
        return []
    w, sizes = kind.window, np.array([len(s) for s in strings], dtype=np.int64)
    codes = np.frombuffer(b"".join(strings), dtype=np.uint8)
    starts = np.cumsum(sizes) - sizes
    symbols = np.repeat(np.arange(len(strings), dtype=np.int64), sizes) << 8 | codes
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    before, after = _equal_near(symbols, w)
    gain = _gains(w)
    change = gain[before]
    leaves = np.flatnonzero(place >= w)
    change[leaves] -= gain[after[leaves - w]]
    sums = np.cumsum(change)
    sums -= np.repeat(sums[starts] - change[starts], sizes)
    suspect = (place >= w - 1) & (sums <= int(w * (np.log2(w) - kind.bits) * UNIT))
    for need in kind.needs:
        member = np.zeros(256, dtype=np.int64)
        member[[c for c in range(128) if re.fullmatch(f"[{need}]", chr(c))]] = 1
        upto = np.concatenate([[0], np.cumsum(member[codes])])
        at = np.flatnonzero(suspect)
        suspect[at[upto[at + 1] == upto[at + 1 - w]]] = False
    ends = np.flatnonzero(suspect)
    edges = np.searchsorted(ends, starts[1:])
    return [e - s - w + 1 for e, s in zip(np.split(ends, edges), starts, strict=True)]


def _blocks(text: str, start: int, end: int, window: int):
    """A candidate in parts of at most BLOCK characters that overlap by a window less one."""
    while True:
        stop = end if end - start <= BLOCK else start + BLOCK
        yield start, text[start:stop].encode("ascii")
        if stop == end:
            return
        start = stop - window + 1


def entropy_spans(texts: list[str], classes=CLASSES, allowed=ALLOWED, alphabets=ALPHABETS) -> list[list[tuple[int, int]]]:
    """(start, end) of the suspect windows of each text, run together where they touch.

    Candidates are the longest runs of a class; one that the allow-list knows as a whole is left out.
    """
    known = [re.compile(x) for x in allowed]
    marks: list[list[tuple[int, int]]] = [[] for _ in texts]
    for kind in classes:
        runs = re.compile(f"[{kind.chars}]{{{kind.window},}}")
        whose, offset, strings = [], [], []
        for i, text in enumerate(texts):
            for m in runs.finditer(text):
                if any(x.fullmatch(m[0]) for x in known) or any(m[0] in x for x in alphabets):
                    continue
                for at, part in _blocks(text, m.start(), m.end(), kind.window):
                    whose.append(i)
                    offset.append(at)
                    strings.append(part)
        for i, at, begins in zip(whose, offset, suspect_windows(strings, kind), strict=True):
            if len(begins):
                gaps = np.flatnonzero(np.diff(begins) > kind.window)
                firsts, lasts = begins[np.r_[0, gaps + 1]], begins[np.r_[gaps, len(begins) - 1]]
                marks[i] += [(at + int(a), at + int(b) + kind.window) for a, b in zip(firsts, lasts, strict=True)]
    return [_joined(sorted(x)) for x in marks]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def secret_spans(texts: list[str], **settings) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of all spans of each text; a suspect string that touches a base span is that secret."""
    out = []
    for text, suspects in zip(texts, entropy_spans(texts, **settings), strict=True):
        base = base_spans(text)
        covered = _joined(sorted((s, e) for s, _, e in base))
        free = [(s, 3, e) for s, e in suspects if not any(a < e and s < b for a, b in covered)]
        out.append(sorted(base + free))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``key`` and ``spans``, an array of (kind, start, end) in code points, end exclusive, by start and then kind.

    Kinds ``assign``, ``access`` and ``hex`` are the fixed patterns; ``entropy`` are further strings of
    ``classes`` with a window of high entropy that ``allowed`` and ``alphabets`` do not name. Rows are
    independent: repeated rows just come again, other columns are ignored, an empty table gives an empty
    result. A null or empty text has no spans. Whole texts are read, however long; bytes that are no UTF-8
    count as one replacement character each.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for a, b in pieces(texts):
                part = texts.slice(a, b - a)
                at = np.flatnonzero(np.asarray(pc.match_substring_regex(part, _HINT)))
                found: list[list] = [[] for _ in range(b - a)]
                whole = [x.decode("utf-8", "replace") for x in part.take(pa.array(at)).to_pylist()]
                for i, spans in zip(at.tolist(), secret_spans(whole, **settings), strict=True):
                    found[i] = [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(found, _SPANS)], ["doc_id", "spans"])

    rows = docs.select(F.col(key).alias("doc_id"), body(text).alias("content"))
    schema = f"doc_id {key_type}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(give_back(run), schema).withColumnRenamed("doc_id", key)


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def span_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda x: x["kind"] != "entropy")
    counts = [F.size(F.expr(f"filter(spans, x -> x.kind = '{k}')")).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select(key, *counts, F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"))
