"""Content-defined runs: every window of a document belongs to the run of the smallest gram hash inside it.

Equal windows have equal smallest hashes, so the windows that could be equal meet under one key, wherever
they stand. A run is a maximal stretch of neighbouring windows with the same key.
"""

from __future__ import annotations

import numpy as np

from robolog.llm.common import mix64, once

BASE = 0x9E3779B97F4A7C15 | 1
_WRAP = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0], have = 1, 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    build = lambda: (_powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size), mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return once(("powers", size), build)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours, by running picks from both sides of blocks."""
    n = len(values)
    rows = -(-n // width)
    padded = np.append(values, np.full(rows * width - n, values[-1], dtype=values.dtype)).reshape(rows, width)
    ahead = pick.accumulate(padded, axis=1).reshape(-1)
    behind = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


def runs(texts: list[bytes], length: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of all windows of ``length`` bytes: text number, first window ``start``, ``stop`` (end of the
    last window), ``key``, ``print`` (XXH3 of the bytes from start to stop, which has nothing in common with
    the rolling hash of grams; of the first window if grams are windows, as all are the same), and ``inner``: whether the run may hold two equal windows itself.
    """
    import xxhash

    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    long_ = np.flatnonzero(sizes >= length)
    none = np.zeros(0, dtype=np.int64)
    if not len(long_):
        return {"text": none, "start": none, "stop": none, "key": none, "print": none, "inner": none.astype(bool)}
    joined = b"".join(texts)
    flat = np.frombuffer(joined, dtype=np.uint8)
    power, inverse, table = _tables(total)
    prefix = np.zeros(total + 1, dtype=np.uint64)
    np.cumsum(table[flat] * power[:total], out=prefix[1:])
    width = length - gram + 1
    grams = mix64((prefix[gram:] - prefix[:-gram]) * inverse[: total - gram + 1])
    least = _sliding(grams, width, np.minimum)
    windows = len(least)
    valid = np.zeros(windows + 1, dtype=np.int8)
    np.add.at(valid, begins[long_], 1)
    np.add.at(valid, np.minimum(ends[long_] - length + 1, windows), -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    new = np.append(True, least[1:] != least[:-1])
    new[begins[long_]] = True
    off = ends[long_] - length + 1
    new[off[off < windows]] = True
    at = np.flatnonzero(new)
    last = np.append(at[1:], windows) - 1
    good = valid[at]
    start, last = at[good], last[good]
    stop = last + length
    key = least[start]
    digest = xxhash.xxh3_64_intdigest
    whole_end = stop if gram < length else start + length
    whole = np.fromiter((digest(joined[a:b]) for a, b in zip(start.tolist(), whole_end.tolist(), strict=True)), dtype=np.uint64, count=len(start))
    # Grams that are the smallest of some window; two neighbours of equal value may mean two equal windows.
    most = np.where(valid, least, np.uint64(0))
    reach = np.concatenate([np.zeros(width - 1, np.uint64), most, np.zeros(width - 1, np.uint64)])
    anchors = np.flatnonzero((_sliding(reach, width, np.maximum)[: len(grams)] == grams) & (grams > 0))
    value = grams[anchors]
    twice = value[1:][value[1:] == value[:-1]]
    text = np.searchsorted(ends, start, side="right")
    return {
        "text": text, "start": start - begins[text], "stop": stop - begins[text], "key": key.view(np.int64),
        "print": whole.view(np.int64), "inner": np.isin(key, twice) if len(twice) else np.zeros(len(key), dtype=bool),
    }
