import random

from robolog.llm.chat_format import format_chats


def brute(rows):
    key = lambda r: tuple((x is not None, x) for x in (r[1], r[2] if r[2] is not None else "unknown", r[3] or ""))
    talks = {}
    for i, r in enumerate(sorted(rows, key=key)):
        talks.setdefault(r[0] if r[0] is not None else ("lone", i), []).append((r[2] if r[2] is not None else "unknown", r[3] or ""))
    same = {}
    for conv, turns in talks.items():
        same.setdefault(tuple(turns), []).append(conv)
    out = []
    for turns, convs in same.items():
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in same):
            continue
        chat = "".join(f"<|{r.replace('<|', '< |')}|>\n{t.replace('<|', '< |')}<|end|>\n" for r, t in turns)
        ids = [c for c in convs if not isinstance(c, tuple)]
        out.append((min(ids) if ids else None, len(turns), len(convs), chat))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def test_agrees_with_brute_force(spark):
    rng = random.Random(1)
    texts = ["hi", "", None, "a<|b", "é", "long " * 3000]
    rows = []
    for conv in range(60):
        turns = [(k, rng.choice(["user", "assistant"]) if k else "user", rng.choice(texts) if k else "hi") for k in range(rng.randint(1, 6))]
        rows += [(conv, *t, "clash") for t in turns]
        if rng.random() < 0.5:  # a snapshot of its beginning
            rows += [(1000 + conv, *t, "clash") for t in turns[: rng.randint(1, len(turns))]]
    rows += [(None, 0, "user", "no id", "x"), (None, 1, "user", "no id", "x"), (None, 0, "user", "hi", None), (None, 0, None, "a<|b", None), (2000, None, None, None, None), (2001, 0, None, "<|end|>", "x"), (2001, 0, None, "<|end|>", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string").repartition(5)
    found = sorted((tuple(r) for r in format_chats(df).collect()), key=lambda r: (r[0] is not None, r))
    assert found == brute(rows)


def test_snapshots_of_one_log_collapse(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(1, 8) for k in range(c)] + [(9, k, "user", f"turn {k}") for k in range(7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [(r.conv_id, r.n_turns, r.n_copies) for r in format_chats(df).collect()] == [(7, 7, 2)]
    assert format_chats(df.where("false")).count() == 0


def test_rows_without_an_id_are_not_gathered(spark):
    rows = [(None, k, "user", f"text {k % 700}") for k in range(2000)] + [(1, 0, "user", "text 1"), (1, 1, "user", "more")]
    found = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(found) == 700 and sum(r.n_copies for r in found) == 2001 - 3 and max(r.n_turns for r in found) == 2
