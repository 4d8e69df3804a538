import hashlib
import random

import pytest
from pyspark.sql import functions as F

from robolog.llm.mixing import leaf_budgets, mix


def fill(children, budget):
    """children: name -> (cap, weight). Raise a common level until the budget is used or all are full."""
    share, open_ = {}, dict(children)
    while open_:
        weight = sum(w for _, w in open_.values())
        full = [n for n, (cap, w) in open_.items() if cap * weight <= w * budget]
        if not full:
            break
        name = min(full, key=lambda n: (open_[n][0] / open_[n][1], n))
        share[name] = open_.pop(name)[0]
        budget -= share[name]
    weight, upto = sum(w for _, w in open_.values()), 0
    for name in sorted(open_, key=lambda n: (open_[n][0] / open_[n][1], n)):
        cap, w = open_[name]
        share[name] = min(cap, budget * (upto + w) // weight - budget * upto // weight)
        upto += w
    return share


def brute_budgets(leaves, weights, budget, epochs):
    caps = {k: v * epochs for k, v in leaves.items()}
    budget = min(budget, sum(caps.values()))
    weigh = lambda level, n: weights.get(level, {}).get(n, 1)
    part = lambda prefix: sum(v for k, v in caps.items() if k[: len(prefix)] == prefix)
    out = {(): budget}
    for depth, level in enumerate(["domain", "lang", "source"]):
        new = {}
        for parent, own in out.items():
            names = {k[depth] for k in caps if k[:depth] == parent}
            shares = fill({n: (part((*parent, n)), weigh(level, n)) for n in names}, own)
            new.update({(*parent, n): s for n, s in shares.items()})
        out = new
    return out


WEIGHTS = {"domain": {"d0": 5, "d1": 1}, "lang": {"en": 3}, "source": {"s1": 7}}


@pytest.mark.parametrize("seed, epochs, percent", [(1, 1, 50), (2, 4, 100), (3, 2, 170), (4, 1, 100), (5, 3, 1)])
def test_budgets_agree_with_raising_a_level(spark, seed, epochs, percent):
    rng = random.Random(seed)
    leaves = {(f"d{d}", lang, f"s{s}"): rng.choice([0, 1, 7, 100, 10_000, 3_000_000]) for d in range(3) for lang in ("en", "de") for s in range(4) if rng.random() < 0.8}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    found = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(df, WEIGHTS, None, percent, epochs).collect()}
    assert found == brute_budgets(leaves, WEIGHTS, sum(leaves.values()) * percent // 100, epochs)


def test_shortage_goes_to_siblings_first(spark):
    leaves = [("d0", "en", "a", 10), ("d0", "en", "b", 1000), ("d0", "de", "a", 1000), ("d1", "en", "a", 1000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    found = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(df, {}, 400, 100, 1).collect()}
    assert found == {("d0", "en", "a"): 10, ("d0", "en", "b"): 90, ("d0", "de", "a"): 100, ("d1", "en", "a"): 200}


def brute_mix(rows, weights, percent, epochs, seed):
    leaves = {}
    size = lambda t: -(-len((t or "").encode()) // 4)
    for i, text, lang, source in rows:
        leaves.setdefault((f"d{len(source) % 2}" if source else "unknown", lang or "unknown", source or "unknown"), []).append((i, size(text)))
    budgets = brute_budgets({k: sum(n for _, n in v) for k, v in leaves.items()}, weights, sum(n for v in leaves.values() for _, n in v) * percent // 100, epochs)
    out = []
    for leaf, docs in leaves.items():
        total = sum(n for _, n in docs)
        times, rest = divmod(budgets[leaf], total) if total else (0, 0)
        order = sorted((hashlib.md5(f"{seed}:{times + 1}:{'' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, n) for i, n in docs)
        before = 0
        for _, known, i, n in order:
            chosen = times + (before < rest)
            before += n
            out += [(i if known else None, *leaf, n, e) for e in range(1, chosen + 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("percent, epochs", [(60, 1), (100, 4), (95, 1)])
def test_mix_agrees_with_brute_force(spark, percent, epochs):
    rng = random.Random(percent)
    rows = [(i, rng.choice(["x", "é", None, ""]) and "w" * rng.randint(0, 400), rng.choice(["en", "de", None]), rng.choice(["s1"] * 6 + ["s22", "s333", None])) for i in range(400)]
    rows += [(5, "same", "en", "s1"), (5, "same", "en", "s1"), (None, "none", "en", "s1"), (777, "long " * 20_000, "de", "s22")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, source string, mix_order string").repartition(6)
    domain = F.concat(F.lit("d"), (F.length("source") % 2).cast("string"))
    found = mix(df, domain, WEIGHTS, budget_percent=percent, max_epochs=epochs, seed=9, keep=["doc_id"])
    assert sorted(map(tuple, found.collect()), key=str) == brute_mix(rows, WEIGHTS, percent, epochs, 9)
    whole = mix(df, domain, WEIGHTS, budget_percent=percent, max_epochs=epochs, seed=9, plan_columns=False)
    assert whole.columns == df.columns and whole.count() == found.count()
    assert mix(df.where("false"), domain, WEIGHTS).count() == 0
