import glob
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from robolog.llm.token_coder import decode_blocks, encode_blocks
from robolog.llm.token_files import UnitTokenizer, read_token_files, token_index, tokenize_to_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def round_trip(blocks):
    blocks = sorted(blocks, key=lambda b: -len(b))
    words = encode_blocks(blocks)
    back = decode_blocks(words, np.array([len(b) for b in blocks], dtype=np.int64))
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, back, strict=True))
    return sum(map(len, words))


def test_blocks_come_back():
    rng = np.random.default_rng(1)
    round_trip([])
    round_trip([rng.integers(0, 1 << 17, size=k) for k in (0, 1, 2, 5, 100, 3000)])
    for seed in range(6):
        rng = np.random.default_rng(seed)
        round_trip([rng.zipf(1.1 + seed / 8, size=rng.integers(0, 600)) % 50257 for _ in range(120)])
    assert round_trip([np.zeros(5000, dtype=np.int64)]) < 200
    assert round_trip([np.tile(rng.integers(0, 50000, size=40), 60)]) < 800


def test_units_make_up_the_library_ids():
    rng = random.Random(2)
    parts = ["a", "B", " ", "  ", "\n", " \n", "\t", "é", "　", "\xa0", "\x1c", "'s", "1", "!", "<|endoftext|>", "日"]
    texts = ["", " ", "a ", " a"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    library = Tokenizer.from_file(PATH)
    ids, counts = UnitTokenizer(PATH).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text
        at += n


def wanted(rows):
    library, out, at = Tokenizer.from_file(PATH), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "äpfel"]) for _ in range(rng.randint(0, 400)))) for i in rng.sample(range(9999), 150)]
    rows += [(None, "no id"), (10_000, None), (10_001, ""), (10_002, "word " * 20_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, content string")
    path = "file://" + str(tmp_path / "tokens")
    write_token_files(df, path, PATH, file_bytes=40_000, block_ids=256, lanes=16)
    assert len(glob.glob(str(tmp_path / "tokens/part-*"))) > 2
    found = token_index(spark, path).collect()
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == wanted(rows)
    ids = {r.doc_id: r.ids for r in read_token_files(spark, path, lanes=5).where("doc_id = 10002").collect()}
    assert ids[10_002] == [*Tokenizer.from_file(PATH).encode("word " * 20_000, add_special_tokens=False).ids, 0]


def test_damage_fails_the_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words that are coded " * 30)], "doc_id long, text string")
    path = str(tmp_path / "tokens")
    write_token_files(df, "file://" + path, PATH)
    file = max(glob.glob(path + "/part-*"), key=lambda f: len(open(f, "rb").read()))
    content = bytearray(open(file, "rb").read())
    content[-20] ^= 1
    with open(file, "wb") as out:
        out.write(content)
    with open(file[: file.rindex("/") + 1] + "." + file.rsplit("/", 1)[1] + ".crc", "wb"):
        pass
    with pytest.raises(Exception):  # noqa: B017
        read_token_files(spark, "file://" + path).collect()


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c")], "doc_id long, text string")
    assert sorted(tuple(r) for r in tokenize_to_files(df, PATH).collect()) == wanted([(1, "a b"), (1, "a b"), (2, "c")])
    assert tokenize_to_files(df.where("false"), PATH).count() == 0


def test_files_come_in_the_order_of_their_numbers(spark, tmp_path):
    """Spark writes more than five digits from the hundred-thousandth file on."""
    path = str(tmp_path / "tokens")
    rows = [(i, f"text number {i} " * (i % 5 + 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    write_token_files(df, path, public_tokenizers.path("byte_bpe_50k.json"), file_bytes=4000)
    names = sorted(glob.glob(f"{path}/part-*"))
    assert len(names) > 3
    for number, name in zip([9998, 10001, 99999, *range(100_000, 100_000 + len(names))], names):
        os.rename(name, name.replace(os.path.basename(name)[:10], f"part-{number:05d}"))
    found = {r.doc_id: (r.start, r.n_tokens) for r in token_index(spark, path).collect()}
    at = 0
    for i, _ in rows:
        assert found[i][0] == at
        at += found[i][1]


def test_rows_without_an_id_are_spread_over_files(spark, tmp_path):
    path = str(tmp_path / "tokens")
    rows = [(None if i % 2 else i, f"text {i} " * 20) for i in range(400)] + [(None, "same " * 40)] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    write_token_files(df, path, public_tokenizers.path("byte_bpe_50k.json"), file_bytes=8000)
    held = [r["count"] for r in read_token_files(spark, path).groupBy("file").count().collect()]
    assert sum(held) == 500 and len(held) > 4 and max(held) < 200


def test_new_units_go_through_the_library_together():
    texts = [" ".join(f"word{i * 100 + k}x, l'été\nof" for k in range(100)) for i in range(30)]
    coder, library, asked = UnitTokenizer(PATH), Tokenizer.from_file(PATH), []

    class Counted:
        def encode_batch_fast(self, some, **options):
            asked.extend(some)
            return library.encode_batch_fast(some, **options)

    coder.tokenizer = Counted()
    ids, counts = coder.encode(texts)
    assert len(asked) < 50  # of more than 3000 units; each went alone before
    assert ids.tolist() == [i for t in texts for i in [*library.encode(t, add_special_tokens=False).ids, 0]]
    assert counts.sum() == len(ids)


def test_units_forgotten_are_asked_for_again(monkeypatch):
    monkeypatch.setattr("robolog.llm.token_files.KEPT_UNITS", 60)
    coder, library = UnitTokenizer(PATH), Tokenizer.from_file(PATH)
    for i in range(40):
        texts = [f"always here  {i} some{i // 2} rare{i}x y", "", f"always z{i} ", " ".join(f"u{i}v{k}" for k in range(20))]
        ids, _ = coder.encode(texts)
        assert ids.tolist() == [i for t in texts for i in [*library.encode(t, add_special_tokens=False).ids, 0]]
        assert len(coder.index) < 120


def test_unlikely_outcomes_and_carries_come_back():
    """Long runs of one outcome, broken by others, take the odds to their ends and the range to carries."""
    rng = np.random.default_rng(5)
    blocks = []
    for _ in range(200):
        block = np.full(rng.integers(500, 1500), rng.integers(0, 1 << 17))
        at = rng.integers(0, len(block), size=rng.integers(0, 30))
        block[at] = rng.integers(0, 1 << 17, size=len(at))
        blocks.append(block)
    round_trip(blocks)
    round_trip([np.arange(3000) % 70_000, np.arange(2000) * 60 % (1 << 17)])
