"""A run-compressed Burrows-Wheeler index of a bounded text, and matching statistics streamed through it."""

from __future__ import annotations

import numpy as np

#: Symbols of an indexed text, at most: three numbers of 21 bits are sorted as one.
MOST_SYMBOLS = (1 << 21) - 2
#: Suffixes are told apart by this many symbols; matches are followed up to fewer.
DEPTH = 128
SEPARATOR = 0


def _renumber(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Order and dense ranks (from 1) of (number << 21 | position), and whether all numbers differ."""
    packed.sort()
    order = (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
    number = packed >> np.uint64(21)
    new = np.append(True, number[1:] != number[:-1])
    rank = np.empty(len(packed), dtype=np.uint64)
    rank[order] = np.cumsum(new).astype(np.uint64)
    return order, rank, bool(new.all())


class RunIndex:
    """Runs of the transform of a text: their symbols, starts, last-to-first bases and text positions of both ends.

    Suffixes are sorted by their first 128 symbols, equal ones by position. A step from a row to that of the
    preceding symbol then leads to a suffix that agrees in 128 symbols with the exact one, which is enough
    for matches that are followed up to ``length`` < 128 symbols.
    """

    def __init__(self, text: np.ndarray, length: int):
        """``text``: small whole numbers, 0 being the separator; ``length``: of the matches to be marked (64 to 127)."""
        if len(text) > MOST_SYMBOLS or not 64 <= length < DEPTH:
            raise ValueError("text too long, or no such length")
        n, place = len(text), np.arange(len(text), dtype=np.uint64)
        self.text, self.length = text, length
        padded = np.append(text, np.zeros(4, text.dtype)).astype(np.uint64)
        code = (padded[:n] << np.uint64(27)) | (padded[1 : n + 1] << np.uint64(18)) | (padded[2 : n + 2] << np.uint64(9)) | padded[3 : n + 3]
        order, rank, unique = _renumber((code << np.uint64(21)) | place)
        depth, at_64 = 4, None
        while depth < DEPTH and not (unique and depth >= 64):
            ahead = np.zeros(n, dtype=np.uint64)
            ahead[: max(0, n - depth)] = rank[depth:]
            if not unique:
                order, rank, unique = _renumber((rank << np.uint64(42)) | (ahead << np.uint64(21)) | place)
            depth *= 2
            if depth == 64:
                at_64 = rank
        # Rows of equal first ``length`` symbols form a class; the first position of each is kept.
        tail = np.zeros(n + length, dtype=np.uint64)
        tail[:n] = at_64
        far = tail[order + (length - 64)]
        near = at_64[order]
        new = np.append(True, (near[1:] != near[:-1]) | (far[1:] != far[:-1]))
        self.class_start = np.flatnonzero(new)
        self.class_first = np.minimum.reduceat(order, self.class_start)
        before = text[order - 1]  # the first suffix is preceded by the last symbol
        self.run_start = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.run_symbol = before[self.run_start].astype(np.int64)
        run_size = np.diff(np.append(self.run_start, n))
        self.run_end = self.run_start + run_size - 1
        self.sample_start, self.sample_end = order[self.run_start], order[self.run_end]
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        size = run_size[by_symbol]
        self.first_row = np.empty(len(size), dtype=np.int64)
        self.first_row[by_symbol] = np.cumsum(size) - size
        self.symbol_runs = self.run_symbol[by_symbol] * (len(size) + 1) + by_symbol
        self.by_symbol = by_symbol

    def step(self, row: np.ndarray, matched: np.ndarray, symbol: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One symbol to the left: rows and lengths of the matches that start at ``at``, given those that start at ``at + 1``.

        Where a row is not preceded by the symbol, the ends of the nearest runs of it, above and below, are the
        rows that agree longest with what follows; their sampled positions tell how long.
        """
        run = np.searchsorted(self.run_start, row, side="right") - 1
        hit = self.run_symbol[run] == symbol
        out = self.first_row[run] + (row - self.run_start[run])
        matched = np.minimum(matched + 1, self.length)
        lost = np.flatnonzero(~hit)
        if len(lost):
            c, runs = symbol[lost], len(self.run_start)
            below = np.searchsorted(self.symbol_runs, c * (runs + 1) + run[lost])
            above = below - 1
            kept = matched[lost] - 1
            best = np.full(len(lost), -1, dtype=np.int64)
            to = np.zeros(len(lost), dtype=np.int64)
            for side, sample, edge in ((above, self.sample_end, self.run_end), (below, self.sample_start, self.run_start)):
                there = (side >= 0) & (side < runs)
                own = self.by_symbol[np.clip(side, 0, runs - 1)]
                there &= self.run_symbol[own] == c
                agree = np.where(there, self._agreement(sample[own], text, at[lost] + 1, kept), -1)
                better = agree > best
                best = np.where(better, agree, best)
                to = np.where(better, self.first_row[own] + (edge[own] - self.run_start[own]), to)
            out[lost] = to
            matched[lost] = np.minimum(best, kept) + 1  # 0 if the symbol does not occur
        return out, matched

    def _agreement(self, own: np.ndarray, text: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols, up to ``most``, the indexed text from ``own`` and the text from ``other`` have in common."""
        found = np.zeros(len(own), dtype=np.int64)
        open_ = np.flatnonzero(most > 0)
        ahead = np.arange(20)
        while len(open_):
            a = own[open_, None] + found[open_, None] + ahead
            b = other[open_, None] + found[open_, None] + ahead
            same = (self.text[np.minimum(a, len(self.text) - 1)] == text[np.minimum(b, len(text) - 1)]) & (a < len(self.text)) & (b < len(text))
            more = np.where(same.all(axis=1), 20, same.argmin(axis=1))
            found[open_] += more
            open_ = open_[(more == 20) & (found[open_] < most[open_])]
        return np.minimum(found, most)

    def first_positions(self, row: np.ndarray) -> np.ndarray:
        """The first text position whose ``length`` symbols are those of the row's suffix."""
        return self.class_first[np.searchsorted(self.class_start, row, side="right") - 1]


def matching_statistics(index: RunIndex, text: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Stream pieces of a text through the index, all at once, each from its end to its beginning.

    Yields at each step (pieces, positions, lengths, rows): the length, up to ``index.length``, of the longest
    match that starts at the position and lies in the piece, and a row of the index that has it.
    """
    order = np.argsort(begin - end, kind="stable")  # longest first, so that pieces leave at the back
    begin, end = begin[order], end[order]
    size = end - begin
    row, matched = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
    for back in range(1, int(size.max(initial=0)) + 1):
        alive = int(np.searchsorted(-size, -back, side="right"))
        at = end[:alive] - back
        row, matched = index.step(row[:alive], matched[:alive], text[at].astype(np.int64), text, at)
        yield order[:alive], at, matched, row


def earlier_windows(snippets: list[bytes], length: int, lane: int = 160) -> list[np.ndarray]:
    """For each snippet the offsets of windows of ``length`` bytes that also start earlier, in an earlier snippet or in itself."""
    sizes = np.array([len(x) for x in snippets], dtype=np.int64)
    text = np.zeros(int(sizes.sum()) + len(snippets), dtype=np.int16)
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    inside = np.ones(len(text), dtype=bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(snippets), dtype=np.uint8).astype(np.int16) + 1
    index = RunIndex(text, length)
    # A long snippet is streamed in several pieces that overlap by a window.
    windows = np.maximum(sizes - length + 1, 0)
    count = -(-windows // lane)
    owner = np.repeat(np.arange(len(snippets)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = begins[owner] + nth * lane
    end = np.minimum(begin + lane + length - 1, ends[owner])
    marked = []
    for _, at, matched, row in matching_statistics(index, text, begin, end):
        full = np.flatnonzero(matched >= length)
        if len(full):
            at = at[full]
            marked.append(at[index.first_positions(row[full]) < at])
    found = np.unique(np.concatenate(marked)) if marked else np.zeros(0, dtype=np.int64)
    cuts = np.searchsorted(found, np.append(begins, len(text)))
    return [found[cuts[i] : cuts[i + 1]] - begins[i] for i in range(len(snippets))]
