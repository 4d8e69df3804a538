"""An adaptive context-mixing range coder for token ids, many independent blocks at a time.

Every block starts with empty models. A token is coded as the outcome of three predictions and, if all fail,
the id itself: the id that last followed the same two ids (order 2), the same one id (order 1), or the id
that last fell into a slot of the ids seen so far (order 0). Two contexts (whether the predictions held the
last time, and the last outcomes) keep adaptive odds of the outcomes, which are mixed by adding them. The
decoder makes the same predictions. Slot numbers and ids, all equally likely, stand beside the code in plain
bits. Blocks run side by side in numpy lanes, one token of each per step.
"""

from __future__ import annotations

import struct

import numpy as np

from robolog.llm.common import spread

SLOT_BITS, HASH_BITS = 8, 8
#: Small tables let the lanes stay in the processor's cache; a slot number of 8 bits costs less than the hits lost.
#: Range coder: 48 bits of state, 16 bits out at a time, ranges of at least 2^32 before a token is coded.
STATE_BITS, LEAST = 48, 1 << 32
#: Odds of a context add up to 2^14, so those of two contexts to 2^15; each token moves them by 1/32.
ODDS_BITS, RATE = 14, 5
ID_BITS = 17


def _packed(fields: list[int]) -> int:
    return sum(x << 16 * i for i, x in enumerate(fields))


#: What lies below the outcomes 1, 2 and 3, in 16 bits each of one number: at first, and what an outcome adds. The
#: step between neighbours is 1 at least, before and after, so no outcome ever becomes impossible.
FIRST = _packed([k << ODDS_BITS - 2 for k in (1, 2, 3)])
WHOLE = 1 << ODDS_BITS - RATE
ADDS = np.array([_packed([WHOLE - 4 + k if o < k else k for k in (1, 2, 3)]) for o in range(4)], dtype=np.int64)
KEPT = _packed([(1 << 16 - RATE) - 1] * 3)
FIELD = 0xFFFF
HASH_ONE, HASH_TWO = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
HEADER = 4


class _Models:
    """Predictions and odds of all lanes; ids are held with 1 added, so that 0 is none."""

    def __init__(self, lanes: int):
        self.follow2 = np.zeros(lanes << HASH_BITS, dtype=np.int32)  # (id + 1) << 1 | whether it held the last time
        self.follow1 = np.zeros(lanes << HASH_BITS, dtype=np.int32)
        self.slots = np.zeros(lanes << SLOT_BITS, dtype=np.int32)
        self.by_trust, self.by_past = np.full(lanes * 8, FIRST, dtype=np.int64), np.full(lanes * 16, FIRST, dtype=np.int64)
        lane = np.arange(lanes, dtype=np.int64)
        self.hashed, self.slotted, self.trusted, self.passed = lane << HASH_BITS, lane << SLOT_BITS, lane * 8, lane * 16
        self.at1, self.at2 = self.hashed.copy(), self.hashed.copy()
        self.product = np.zeros(lanes, dtype=np.uint32)
        self.two = np.zeros(lanes, dtype=np.uint32)
        self.past = np.zeros(lanes, dtype=np.int64)

    def predict(self, n: int) -> np.ndarray:
        """Predictions of the first ``n`` lanes; gives the mixed odds, packed."""
        e2, e1 = self.follow2.take(self.at2[:n], mode="clip"), self.follow1.take(self.at1[:n], mode="clip")
        self.id2, self.id1 = e2 >> 1, e1 >> 1
        trust = (e2 & 1) << 1
        trust |= e1 & 1
        trust <<= 1
        trust |= self.id2 == self.id1
        self.row_trust, self.row_past = self.trusted[:n] + trust, self.passed[:n] + self.past[:n]
        self.held_trust, self.held_past = self.by_trust.take(self.row_trust, mode="clip"), self.by_past.take(self.row_past, mode="clip")
        return self.held_trust + self.held_past

    def learn(self, n: int, own: np.ndarray, product: np.ndarray, slot: np.ndarray, outcome: np.ndarray) -> None:
        """``own``: ids with 1 added; ``product``: hashes of them, ``slot``: their places among the slots of all lanes."""
        new = own << 1
        self.follow2[self.at2[:n]] = new | (self.id2 == own)
        self.follow1[self.at1[:n]] = new | (self.id1 == own)
        self.slots[slot] = own
        adds = ADDS.take(outcome, mode="clip")
        for odds, row, held in ((self.by_trust, self.row_trust, self.held_trust), (self.by_past, self.row_past, self.held_past)):
            less = held >> RATE
            less &= KEPT
            held -= less
            held += adds
            odds[row] = held
        past = self.past[:n]
        past <<= 2
        past |= outcome
        past &= 15
        np.add(self.hashed[:n], product >> np.uint32(32 - HASH_BITS), out=self.at1[:n])
        np.add(self.hashed[:n], (self.two[:n] + product) >> np.uint32(32 - HASH_BITS), out=self.at2[:n])
        np.multiply(product, HASH_TWO, out=self.two[:n])


def _plain(values: np.ndarray, low: int, high: int) -> bytes:
    """Whole 16-bit words: the low 8 or 16 bits of values, then each of the ``high`` bits above them."""
    held = values.astype("<u1" if low == 8 else "<u2").tobytes()
    for k in range(low, low + high):
        held += np.packbits((values & (1 << k)) != 0).tobytes()
    return held + b"\0" * (len(held) % 2)


def _plain_words(count: int, low: int, high: int) -> int:
    return (count * low // 8 + -(-count // 8) * high + 1) // 2


def _unplain(words: np.ndarray, count: int, low: int, high: int) -> np.ndarray:
    held = words.astype("<u2").tobytes()
    at, step = count * low // 8, -(-count // 8)
    values = np.frombuffer(held, "<u1" if low == 8 else "<u2", count).astype(np.int32)
    for k in range(high):
        values |= np.unpackbits(np.frombuffer(held, np.uint8, step, at + k * step), count=count).astype(np.int32) << (low + k)
    return values


def encode_blocks(blocks: list[np.ndarray]) -> list[np.ndarray]:
    """Words (unsigned 16-bit) of each block of ids below 2^17. Blocks must come longest first."""
    lanes = len(blocks)
    sizes = np.array([len(b) for b in blocks], dtype=np.int64)
    longest = int(sizes.max(initial=0))
    ids = np.zeros((lanes, longest), dtype=np.int32)
    for i, b in enumerate(blocks):
        ids[i, : len(b)] = b
    ids = np.ascontiguousarray(ids.T)
    outcomes = np.zeros((longest, lanes), dtype=np.uint8)
    running = np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()
    models = _Models(lanes)
    low, span = np.zeros(lanes, dtype=np.int64), np.full(lanes, 1 << STATE_BITS, dtype=np.int64)
    room = longest + 2
    out, used = np.zeros(lanes * room, dtype=np.int32), np.arange(lanes, dtype=np.int64) * room
    top = np.int64(1 << ODDS_BITS + 1)
    for t in range(longest):
        n = running[t]
        own = ids[t, :n] + 1
        odds = models.predict(n)
        product = own.view(np.uint32) * HASH_ONE
        slot = models.slotted[:n] + (product >> np.uint32(32 - SLOT_BITS))
        seen = models.slots.take(slot, mode="clip") == own
        # 0 if order 2 holds, 1 if only order 1 does, 2 if only the slot does, else 3
        miss2, miss1, miss0 = models.id2 != own, models.id1 != own, ~seen
        miss1 &= miss2
        miss0 &= miss1
        outcome = outcomes[t, :n]
        np.add(miss2.view(np.uint8), miss1.view(np.uint8), out=outcome)
        outcome += miss0.view(np.uint8)
        wide = outcome.astype(np.int64)
        # Packed below-counts, with 0 put before them and the whole behind.
        wide <<= 4
        both = odds << 16
        first = (both >> wide) & FIELD
        upper = (odds >> wide) & FIELD
        upper += miss0 * top
        lo, sp = low[:n], span[:n]
        part = sp >> ODDS_BITS + 1
        upper -= first
        first *= part
        lo += first
        np.multiply(upper, part, out=sp)
        at = np.flatnonzero(sp < LEAST)
        if len(at):
            to, lows = used[at], lo[at]
            out[to] = lows >> 32
            used[at] = to + 1
            lo[at] = (lows & (LEAST - 1)) << 16
            sp[at] <<= 16
        models.learn(n, own, product, slot, outcome)
    out[used] = (low + (LEAST - 1)) >> 32  # inside the last range; zeros follow
    lengths = used + 1 - np.arange(lanes, dtype=np.int64) * room
    out = out[spread(used + 1 - lengths, lengths)]
    while (over := np.flatnonzero(out > FIELD)).size:  # carries go to the word before, a block's first has none
        out[over] -= 1 << 16
        out[over - 1] += 1
    codes = np.split(out.astype(np.uint16), np.cumsum(lengths)[:-1])
    ids, outcomes, words = np.ascontiguousarray(ids.T), np.ascontiguousarray(outcomes.T), []
    for i, size in enumerate(sizes.tolist()):
        own, outcome = ids[i, :size], outcomes[i, :size]
        rest = own[outcome == 3]
        slots = (own[outcome == 2] + 1).view(np.uint32) * HASH_ONE >> np.uint32(32 - SLOT_BITS)
        held = struct.pack("<II", len(slots), len(rest)) + _plain(slots, 8, SLOT_BITS - 8) + _plain(rest, 16, ID_BITS - 16)
        words.append(np.append(np.frombuffer(held, "<u2"), codes[i]))
    return words


def decode_blocks(words: list[np.ndarray], sizes: np.ndarray) -> list[np.ndarray]:
    """The ids of each block, given its words and its number of ids. Blocks must come longest first."""
    lanes, longest = len(words), int(sizes.max(initial=0))
    codes, slots, rest = [], [], []
    for w in words:
        n_slots, n_rest = np.ascontiguousarray(w[:HEADER]).astype("<u2").view("<u4").tolist()
        a = HEADER + _plain_words(n_slots, 8, SLOT_BITS - 8)
        b = a + _plain_words(n_rest, 16, ID_BITS - 16)
        slots.append(_unplain(w[HEADER:a], n_slots, 8, SLOT_BITS - 8))
        rest.append(_unplain(w[a:b], n_rest, 16, ID_BITS - 16))
        codes.append(np.append(w[b:], np.zeros(4, dtype=np.uint16)))
    place = lambda parts: np.cumsum([0, *map(len, parts)])[:-1]
    flat, read, slot_at, rest_at = (np.concatenate(codes).astype(np.int64) if codes else np.zeros(4, np.int64)), place(codes), place(slots), place(rest)
    last = read + np.array([len(c) for c in codes], dtype=np.int64) - 1
    slots, rest = (np.concatenate([*x, [0]]).astype(np.int32) for x in (slots, rest))
    running = np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()
    models = _Models(lanes)
    span = np.full(lanes, 1 << STATE_BITS, dtype=np.int64)
    code = (flat[read] << 32) | (flat[read + 1] << 16) | flat[read + 2]
    read = read + 3
    ids = np.zeros((longest, lanes), dtype=np.int32)
    bounds = np.zeros((5, lanes), dtype=np.int64)
    lane = np.arange(lanes, dtype=np.int64)
    for t in range(longest):
        n = running[t]
        odds = models.predict(n)
        co, sp = code[:n], span[:n]
        part = sp >> ODDS_BITS + 1
        if bounds.shape[1] != n:
            bounds = np.zeros((5, n), dtype=np.int64)
        np.multiply(odds & FIELD, part, out=bounds[1])
        odds >>= 16
        np.multiply(odds & FIELD, part, out=bounds[2])
        odds >>= 16
        np.multiply(odds, part, out=bounds[3])
        np.left_shift(part, ODDS_BITS + 1, out=bounds[4])
        outcome = (co >= bounds[1]).view(np.uint8) + (co >= bounds[2]).view(np.uint8)
        outcome += (co >= bounds[3]).view(np.uint8)
        at = lane[:n] + outcome * np.int64(n)
        below = bounds.ravel().take(at, mode="clip")
        at += n
        bounds.ravel().take(at, mode="clip", out=sp)
        sp -= below
        co -= below
        at = np.flatnonzero(sp < LEAST)
        if len(at):
            where = read[at]
            code[at] = (co[at] << 16) | flat[np.minimum(where, last[at])]
            read[at] = where + 1
            sp[at] <<= 16
        own = np.where(outcome == 0, models.id2, models.id1)
        # What the next slot number of each lane would give, whether it is wanted or not.
        slotted = outcome == 2
        np.copyto(own, models.slots.take(models.slotted[:n] + slots.take(slot_at[:n], mode="clip"), mode="clip"), where=slotted)
        slot_at[:n] += slotted
        at = np.flatnonzero(outcome == 3)
        where = rest_at[at]
        own[at] = rest.take(where, mode="clip") + 1
        rest_at[at] = where + 1
        np.subtract(own, 1, out=ids[t, :n])
        product = own.view(np.uint32) * HASH_ONE
        models.learn(n, own, product, models.slotted[:n] + (product >> np.uint32(32 - SLOT_BITS)), outcome)
    ids = np.ascontiguousarray(ids.T)
    return [ids[i, : sizes[i]] for i in range(lanes)]
