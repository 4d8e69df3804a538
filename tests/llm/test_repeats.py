import hashlib
import random

import numpy as np
import pytest

from robolog.llm.anchors import runs
from robolog.llm.repeats import remove_repeats, repeated_stretches
from robolog.llm.run_index import RunIndex, earlier_windows, matching_statistics


def brute(rows, length=100):
    seen, out = set(), {}
    for i, text in rows:
        content = (text or "").encode()
        gone = bytearray(len(content))
        for s in range(len(content) - length + 1):
            window = content[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(content, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(content), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def noise(seed, n, letters="abcdefgh"):
    rng = random.Random(seed)
    return "".join(rng.choice(letters) for _ in range(n))


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 30, 60, 200)]
    texts = [None, "", "a" * 99, "a" * 100, "a" * 101, "a" * 5000, "ab" * 700, "ab" * 699 + "x", passages[2], passages[2]]
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 4))]
        parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        own = list(" ".join(parts))
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = "#"
        texts.append("".join(own))
    rng.shuffle(texts)
    return list(zip(rng.sample(range(10_000), len(texts)), texts))


@pytest.mark.parametrize("sizes", [{}, {"index_bytes": 2000}, {"index_bytes": 150}, {"index_bytes": 600, "held_runs": 50}])
def test_removed_bytes_agree_with_brute_force(spark, sizes):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, key string").repartition(5)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, digests=True, **sizes).collect()}
    assert found == brute(sorted(rows))


def test_spans_and_remaining_bytes(spark):
    passage = noise(1, 150)
    df = spark.createDataFrame([(1, "x" + passage), (2, "head " + passage + " tail"), (3, "é" + passage)], "doc_id long, text string")
    found = {r.doc_id: r for r in remove_repeats(df).collect()}
    assert found[1].spans == [] and bytes(found[1].kept).decode() == "x" + passage
    assert [tuple(s) for s in found[2].spans] == [(5, 155)] and bytes(found[2].kept) == b"head  tail"
    assert bytes(found[3].kept) == "é".encode()


def test_repeated_rows_shared_ids_null_ids_and_empty_tables(spark):
    a, b = noise(1, 120), noise(2, 120)
    df = spark.createDataFrame([(4, a), (4, a), (5, a), (6, a), (6, b), (None, b)], "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.n_removed) for r in remove_repeats(df).collect())
    # Rows that repeat id and text are one document; the null id comes first.
    assert found == [(-1, 0), (4, 0), (4, 0), (5, 120), (6, 120), (6, 120)]
    assert remove_repeats(df.where("false"), digests=True).count() == 0


def test_crowded_keys_are_cut_until_they_fit_an_index(spark):
    """A passage in very many surroundings, and runs of one letter of very many lengths: no window is compared outside an index,
    but those that grams of their own length tell apart."""
    passage = noise(9, 140)
    texts = [noise(100 + i, 90) + passage + noise(300 + i, 90) for i in range(80)] + ["a" * (150 + 7 * i) for i in range(60)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc long, text string").selectExpr("doc", "CAST(text AS BINARY) AS content").repartition(5)
    ways = {(r.gram, r.path) for r in repeated_stretches(df, index_bytes=3000).select("gram", "path").distinct().collect()}
    assert (100, "equal") in ways and any(path == "index" and gram > 48 for gram, path in ways) and (100, "index") not in ways
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, digests=True, index_bytes=3000).collect()}
    assert found == brute(rows)


def test_many_texts_without_an_id_or_with_the_same(spark):
    texts = [noise(i, 150) + noise(i % 7, 130) for i in range(60)]
    rows = [(None, t) for t in texts[:30]] + [(3, t) for t in texts[25:50]] + [(3, texts[30])] + [(1 << 40, t) for t in texts[40:]] + [(-5, texts[59])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    order = df.distinct().selectExpr("doc_id", "text", "xxhash64(CAST(text AS BINARY)) AS h1", "xxhash64(1, CAST(text AS BINARY)) AS h2").collect()
    documents = [(r.doc_id, r.text) for r in sorted(order, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h1, r.h2))]
    want = brute([(k, text) for k, (_, text) in enumerate(documents)])
    by_document = {x: want[k] for k, x in enumerate(documents)}
    found = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in remove_repeats(df, digests=True).collect()]
    assert sorted(found, key=str) == sorted(((i, by_document[i, t]) for i, t in rows), key=str)


def test_long_texts_are_cut_with_an_overlap(spark, monkeypatch):
    from robolog.llm import repeats

    monkeypatch.setattr(repeats, "PART_BYTES", 500)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh") for _ in range(1700))
    rows = [(1, "12" + passage), (2, passage + "9" + passage[300:900]), (3, "".join(rng.choice("abcdefgh") for _ in range(2600)) + passage[800:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, digests=True).collect()}
    assert found == brute(rows)


def test_equal_windows_meet_under_one_key():
    texts = [(t or "").encode() for _, t in corpus(7)]
    found = runs(texts, 100, 48)
    keys, covered = {}, 0
    for text, start, stop, key in zip(found["text"], found["start"], found["stop"], found["key"]):
        for s in range(start, stop - 99):
            covered += 1
            assert keys.setdefault(texts[text][s : s + 100], key) == key
    assert covered == sum(max(0, len(t) - 99) for t in texts)


def test_matching_statistics_of_other_texts():
    rng = random.Random(3)
    for trial in range(20):
        text = bytes(rng.choice(b"abc") for _ in range(600))
        other = bytes(rng.choice(b"abcz") for _ in range(300)) if trial % 2 else text[50:180] + b"z" + text[300:420]
        index = RunIndex(np.append(np.frombuffer(text, np.uint8).astype(np.int16) + 1, 0).astype(np.int16), 100)
        symbols = np.frombuffer(other, np.uint8).astype(np.int16) + 1
        found = {int(at[0]): int(m[0]) for _, at, m, _ in matching_statistics(index, symbols, np.array([0]), np.array([len(other)]))}
        for i in range(len(other)):
            k = 0
            while k < 100 and i + k < len(other) and other[i : i + k + 1] in text:
                k += 1
            assert found[i] == k


def test_windows_of_snippets():
    rng = random.Random(5)
    for trial in range(30):
        base = bytes(rng.choice(b"ab" if trial % 2 else b"abcd") for _ in range(600))
        snippets = [base[i : i + rng.randint(0, 400)] for i in (rng.randrange(600) for _ in range(12))] + [b"a" * 400, b"ab" * 200 + b"c" + b"ab" * 200]
        seen, want = set(), []
        for s in snippets:
            want.append([i for i in range(len(s) - 99) if s[i : i + 100] in seen or seen.add(s[i : i + 100])])
        assert [x.tolist() for x in earlier_windows(snippets, 100)] == want
