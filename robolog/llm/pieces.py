"""SentencePiece encoding and decoding: byte-pair merges in vectorised rounds over all words at once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from robolog.llm.common import body, give_back, once, pieces, spread

SPACE = "▁"
#: The rank of a pair that does not merge.
NEVER = np.int64(1 << 40)
#: Words whose ids a worker keeps.
KEPT_WORDS = 150_000


class KeyIndex:
    """Position of a key among distinct keys, by multiplicative hashing; keys that collide go on to the next table."""

    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, -1)  # the last entry matches no key
        bits = max(4, int(len(keys)).bit_length() + 3)
        self.shift, self.tables = np.uint64(64 - bits), []
        rest = np.arange(len(keys))
        for multiplier in self.MULTIPLIERS:
            slot = self._slot(keys[rest], multiplier)
            first = np.unique(slot, return_index=True)[1]
            at = np.full(1 << bits, len(keys), dtype=np.int32)
            at[slot[first]] = rest[first]
            later = np.ones(len(rest), dtype=bool)
            later[first] = False
            crowded = np.zeros(1 << bits, dtype=bool)
            crowded[slot[later]] = True
            self.tables.append((multiplier, at, crowded))
            rest = rest[later]
            if not len(rest):
                return
        raise ValueError("too many collisions")

    def _slot(self, keys: np.ndarray, multiplier: int) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(multiplier)) >> self.shift

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position (anything where absent) and whether the key is there."""
        multiplier, table, crowded = self.tables[0]
        slot = self._slot(keys, multiplier)
        at = table[slot]
        hit = self.keys[at] == keys
        open_ = np.flatnonzero(~hit & crowded[slot])
        for multiplier, table, crowded in self.tables[1:]:
            if not len(open_):
                break
            slot = self._slot(keys[open_], multiplier)
            at[open_] = table[slot]
            found = self.keys[at[open_]] == keys[open_]
            hit[open_] = found
            open_ = open_[~found & crowded[slot]]
        return at, hit


class PieceModel:
    """A SentencePiece byte-pair model as flat tables.

    Supported are models with the identity normaliser, a dummy prefix, kept white space, byte fallback
    and no user-defined pieces, in which a space stands only at the front of a piece; others are refused.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        model = spec.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        normal, trainer = model.normalizer_spec, model.trainer_spec
        names = [p.piece for p in model.pieces]
        kinds = np.array([p.type for p in model.pieces])  # 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
        plain = normal.name == "identity" and normal.add_dummy_prefix and not normal.remove_extra_whitespaces
        if trainer.model_type != 2 or not plain or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or np.isin(kinds, [4, 5]).any():
            raise ValueError(f"{path}: this kind of model is not supported")
        if any(SPACE in x.lstrip(SPACE) for x, k in zip(names, kinds, strict=True) if k == 1):
            raise ValueError(f"{path}: a piece has a space after another character")
        self.begin, self.end = self.processor.bos_id(), self.processor.eos_id()
        self.size = len(names)
        known = {x: i for i, x in enumerate(names) if kinds[i] == 1}
        # Characters that only occur inside pieces get symbols of their own beyond the vocabulary.
        symbols = dict(known)
        for x in sorted({c for x in known for c in x} - known.keys()):
            symbols[x] = len(names) + len(symbols) - len(known)
        self.unknown = len(names) + len(symbols) - len(known)
        self.width = self.unknown + 1
        self.char_symbol = np.full(0x110000, self.unknown, dtype=np.int64)
        for x, i in symbols.items():
            if len(x) == 1:
                self.char_symbol[ord(x)] = i
        scores = np.array([p.score for p in model.pieces], dtype=np.float32)
        order = {s: i for i, s in enumerate(sorted({float(scores[i]) for i in known.values()}, reverse=True))}
        pairs = [
            (symbols[x[:k]] * self.width + symbols[x[k:]], i, order[float(scores[i])])
            for x, i in known.items() for k in range(1, len(x)) if x[:k] in symbols and x[k:] in symbols
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3)
        self.pairs = KeyIndex(table[:, 0])
        self.pair_piece, self.pair_rank = np.append(table[:, 1], 0), np.append(table[:, 2], NEVER)
        # Adjacent characters that no piece holds side by side: a word can be cut there.
        inside = {ord(x[k]) << 21 | ord(x[k + 1]) for x in known for k in range(len(x) - 1)}
        self.adjacent = KeyIndex(np.array(sorted(inside), dtype=np.int64))
        self.byte_id = np.array([known.get(f"<0x{b:02X}>", names.index(f"<0x{b:02X}>")) for b in range(256)], dtype=np.int64)
        outs = [b"" if kinds[i] == 3 else bytes([int(x[3:5], 16)]) if kinds[i] == 6 else " ⁇ ".encode() if kinds[i] == 2 else x.replace(SPACE, " ").encode() for i, x in enumerate(names)]
        self.out_length = np.array([len(x) for x in outs], dtype=np.int64)
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out_bytes = np.frombuffer(b"".join(outs), dtype=np.uint8)
        self.is_byte, self.is_control = kinds == 6, kinds == 3

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of adjacent symbols; rank NEVER where they do not merge."""
        keys = left * self.width + right
        at, hit = self.pairs.find(keys)
        return np.where(hit, self.pair_rank[at], NEVER), self.pair_piece[at]

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and the number of ids of each."""
        text = "".join(words)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        # Cut where no piece reaches across; each cut part then merges on its own.
        cut = np.ones(len(chars), dtype=bool)
        if len(chars) > 1:
            cut[1:] = (word[1:] != word[:-1]) | ~self.adjacent.find(chars[:-1] << 21 | chars[1:])[1]
        part = np.cumsum(cut) - 1
        where = np.arange(len(chars))  # first character of each symbol
        sym = self.char_symbol[chars]
        done_at, done_sym = [], []
        while len(sym):
            same = part[:-1] == part[1:]
            rank, merged = self.ranks(sym[:-1], sym[1:])
            rank = np.append(np.where(same, rank, NEVER), NEVER)
            starts = np.flatnonzero(np.append(True, ~same))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            open_part = best < NEVER
            if not open_part.all():  # compaction: finished parts leave the arrays
                stay = np.repeat(open_part, sizes)
                done_at.append(where[~stay])
                done_sym.append(sym[~stay])
                where, sym, part, rank = where[stay], sym[stay], part[stay], rank[stay]
                merged = np.append(merged, 0)[stay]
                best, sizes = best[open_part], sizes[open_part]
                if not len(sym):
                    break
            else:
                merged = np.append(merged, 0)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            floor = best[owner]
            chosen = _leftmost(rank == floor)
            first = np.zeros(len(sym), dtype=bool)
            hits = np.flatnonzero(chosen)
            _, head = np.unique(owner[hits], return_index=True)
            first[hits[head]] = True
            taken = chosen
            if len(head) < len(hits):
                # Several merges of one part go together unless one of them makes a pair that comes before the rest.
                sym2, keep2 = _apply(sym, merged, chosen)
                new = chosen[keep2]
                part2, floor2 = part[keep2], floor[keep2]
                rank2, _ = self.ranks(sym2[:-1], sym2[1:])
                sooner = (part2[:-1] == part2[1:]) & (new[:-1] | new[1:]) & (rank2 <= floor2[:-1])
                if sooner.any():
                    hasty = np.zeros(len(sizes), dtype=bool)
                    hasty[owner[keep2][:-1][sooner]] = True
                    taken = np.where(hasty[owner], first, chosen)
            sym, keep = _apply(sym, merged, taken)
            where, part = where[keep], part[keep]
        at = np.concatenate(done_at) if done_at else np.zeros(0, np.int64)
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        order = np.argsort(at, kind="stable")
        at, sym = at[order], sym[order]
        owner = word[at]
        strange = np.flatnonzero(sym >= self.size)
        if len(strange):  # characters without a piece: one id for each byte
            spelled = [text_char.encode("utf-8", "replace") for text_char in map(chr, chars[at[strange]].tolist())]
            count = np.ones(len(sym), dtype=np.int64)
            count[strange] = [len(x) for x in spelled]
            out = np.repeat(sym, count)
            ends = np.cumsum(count)
            out[spread((ends - count)[strange], count[strange])] = self.byte_id[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
            sym, owner = out, np.repeat(owner, count)
        return sym, np.bincount(owner, minlength=len(words))

    def encode(self, texts: Iterable[str], kept: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other (without begin and end), and the number of ids of each.

        ``kept`` maps words to (start, length) in ``kept_ids`` of earlier calls; see :class:`WordCache`.
        """
        cache = kept if kept is not None else WordCache(self)
        rows, counts = [], []
        for text in texts:
            words = split_words(text)
            rows.extend(words)
            counts.append(len(words))
        start, length = cache.find(rows)
        ids = cache.ids[spread(start, length)]
        ends = np.cumsum(np.append(0, length))
        upto = np.cumsum(np.append(0, np.array(counts, dtype=np.int64)))
        return ids, np.diff(ends[upto])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The text of the ids in UTF-8, as the library's decode gives it."""
        ids = ids[~self.is_control[ids]]
        out = self.out_bytes[spread(self.out_start[ids], self.out_length[ids])].tobytes()
        if len(ids) and not self.is_byte[ids[0]] and out[:1] == b" " and self.out_length[ids[0]] and ids[0] != self.processor.unk_id():
            out = out[1:]
        try:
            out.decode()
        except UnicodeDecodeError:  # byte pieces that form no characters
            out = self.processor.decode(ids.tolist()).encode()
        return out


def _leftmost(hit: np.ndarray) -> np.ndarray:
    """Of overlapping hits (neighbours) every other one, from the left; a run never spans two parts, as a part's last symbol is no hit."""
    start = hit & ~np.append(False, hit[:-1])
    at = np.arange(len(hit))
    since = at - np.maximum.accumulate(np.where(start, at, 0))
    return hit & (since % 2 == 0)


def _apply(sym: np.ndarray, merged: np.ndarray, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after the merges, and the positions that remain."""
    keep = np.flatnonzero(~np.append(False, taken[:-1]))
    return np.where(taken, merged, sym)[keep], keep


_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def split_words(text: str) -> list[str]:
    """A text as words without their first space mark; the dummy prefix gives the first word its mark."""
    if not text:
        return []
    text = text.replace(" ", SPACE)
    if SPACE + SPACE not in text and text[-1] != SPACE and text[0] != SPACE:
        return text.split(SPACE)
    return [x[1:] for x in _RUNS.findall(SPACE + text)]


class WordCache:
    """Ids of words met before; words new to a call are merged together in one run of rounds."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint16 if self.model.size <= 1 << 16 else np.uint32)

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > KEPT_WORDS or len(self.ids) > 16 * KEPT_WORDS:
            self.clear()
        index = self.index
        new = [w for w in dict.fromkeys(words) if w not in index]
        if new:
            ids, length = self.model.merge_words([SPACE + w for w in new])
            base = len(self.start)
            index.update(zip(new, range(base, base + len(new)), strict=True))
            self.start = np.append(self.start, len(self.ids) + np.cumsum(length) - length)
            self.length = np.append(self.length, length)
            self.ids = np.append(self.ids, ids.astype(self.ids.dtype))
        at = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
        found = self.start[at], self.length[at]
        return found


def piece_model(path: str) -> tuple[PieceModel, WordCache]:
    def build():
        model = PieceModel(path)
        return model, WordCache(model)

    return once(("pieces", path), build)


def encode_texts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """One row per row: ``key``, n_tokens, ids (with begin and end id) and decoded, the text those ids stand for.

    With ``digests`` ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256 instead, so that long id lists do not leave the worker. A null text counts as empty.
    Rows are independent, hence repeated rows and ids just come again; other columns are ignored. Texts
    are taken in groups of about a megabyte, a longer one by itself. ``model_path`` must exist on every executor.
    """
    key_type = docs.schema[key].dataType.simpleString()
    columns = "n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")

    def run(batches):
        model, cache = piece_model(model_path)
        begin, end = np.uint32(model.begin), np.uint32(model.end)
        for batch in batches:
            texts = batch.column(1)
            for a, b in pieces(texts, 1 << 20):
                ids, counts = model.encode((x.decode("utf-8", "replace") for x in texts.slice(a, b - a).to_pylist()), cache)
                out, at = [], 0
                for n in counts.tolist():
                    own = np.empty(n + 2, dtype="<u4")
                    own[0], own[1:-1], own[-1] = begin, ids[at : at + n], end
                    at += n
                    decoded = model.decode_bytes(own)
                    if digests:
                        out.append((n + 2, hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                    else:
                        out.append((n + 2, own.astype(np.int32), decoded.decode()))
                types = [pa.int64(), *([pa.string(), pa.string()] if digests else [pa.list_(pa.int32()), pa.string()])]
                names = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
                arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *arrays], ["doc_id", *names])

    rows = docs.select(F.col(key).alias("doc_id"), body(text).alias("content"))
    return rows.mapInArrow(give_back(run), f"doc_id {key_type}, {columns}").withColumnRenamed("doc_id", key)
