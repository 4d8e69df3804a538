import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from robolog.llm.pieces import PieceModel, WordCache, encode_texts, split_words

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def agrees(model, texts):
    ids, counts = model.encode(texts, WordCache(model))
    at = 0
    for text, n in zip(texts, counts.tolist()):
        own = ids[at : at + n].tolist()
        at += n
        assert own == model.processor.encode(text), text[:80]
        assert model.decode_bytes(np.array([1, *own, 2])) == model.processor.decode([1, *own, 2]).encode()


def test_special_texts(model):
    agrees(model, [
        "", " ", "  ", "a", " a", "a ", "▁", "a▁b", "\n", "a\nb", "日本語", "😀", "a" * 5000, "ab" * 3000, "é" * 999, "the" * 2000, " " * 300 + "x",
        "\x00a", "<s> </s> <0x41> <unk>", "\t\tfoo\tbar", "== == ==", "1234567890" * 50, "-" * 1000, "�", "thethe " * 50,
    ])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aabbcdeehhnorst  \n.-▁é日0ß"), max_size=300), max_size=5))
def test_any_text(model, texts):
    agrees(model, texts)


def test_repeated_merges_that_meet(model):
    rng = random.Random(1)
    agrees(model, ["".join(rng.choice(["the", "er", "an", "in", "th", "at", "ththe"]) for _ in range(rng.randint(1, 80))) for _ in range(300)])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=40))
def test_any_ids_decode_like_the_library(model, ids):
    ids = [i for i in ids if i != model.processor.unk_id()]
    assert model.decode_bytes(np.array(ids, dtype=np.int64)) == model.processor.decode(ids).encode()


def test_words_make_up_the_text():
    for text in ["a b", " a", "a ", "a  b", "▁", "\n x "]:
        assert "".join("▁" + w for w in split_words(text)) == "▁" + text.replace(" ", "▁")


def test_tables(spark, model):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, ""), (3, "x " * 50_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    found = encode_texts(df, PATH, digests=True).collect()
    for (i, text), row in zip(rows, found, strict=True):
        ids = [1, *model.processor.encode(text or ""), 2]
        plain = np.array(ids, dtype="<u4").tobytes()
        assert (row.doc_id, row.n_tokens, row.ids_sha256) == (i, len(ids), hashlib.sha256(plain).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(model.processor.decode(ids).encode()).hexdigest()
    assert [(r.n_tokens, r.decoded) for r in encode_texts(df.limit(1), PATH).collect()] == [(found[0].n_tokens, "Hello  world")]
    assert encode_texts(df.where("false"), PATH).count() == 0
