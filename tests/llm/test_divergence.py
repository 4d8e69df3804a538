import random
import re
from collections import Counter, defaultdict

import pytest

from robolog.llm.divergence import source_divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string"


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, least_docs):
    """The statement of the operator, group by group and term by term."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = Counter(terms_of(text))
        count[lang or "", source or ""].update(found)
        docs[lang or ""].update(dict.fromkeys(found, 1))
    out = set()
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        sources = [s for x, s in count if x == lang]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = shares(sum((count[lang, s] for s in sources), Counter()))
        own = {s: shares(count[lang, s]) for s in sources}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            pairs = [(-sum(apart(own[s][t], own[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            top = [(-apart(own[s][t], whole[t]), t.encode()) for t in kept if count[lang, s][t] and own[s][t] > whole[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(top)[:10])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(ranked)}
    return out


def found(df, **settings):
    rows = [tuple(r) for r in source_divergence(df, **settings).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cells", [1 << 20, 7])
def test_agrees_with_brute_force(spark, cells):
    random.seed(3)
    words = ["Ab", "ab", "É", "é", "bßz", "x-y", "日本", "one", "two", "three", "four", "five", "SIX", "seven's", "kK", "ſ"]
    rows = [
        (i, " ".join(random.choices(words, weights=range(1, len(words) + 1), k=random.randrange(30))), random.choice(["en", "de", None, ""]),
         random.choice(["a", "b", "c", None]), i, "clash") for i in range(250)]
    rows += [(1, None, "en", "empty", 0, None), (1, "", "fr", "lone", 0, None), (2, "12 34", "fr", "other", 0, None), (None, "rare words here", "xx", "x", 0, None)]
    rows += [(9, "one " * 30_000, "en", "a", 0, None)] * 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for least in (1, 10):
        assert found(df, least_docs=least, shard_cells=cells) == brute(rows, least)


def test_a_language_without_kept_terms_has_zero_pairs(spark):
    rows = [(1, "a", "en", "x", 0, None), (2, "b", "en", "y", 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
    assert found(df.where("false")) == set()


def test_ties_rank_by_utf8_and_ten_terms_at_most(spark):
    rows = [(i, " ".join(f"w{chr(97 + j)}" for j in range(20)) + " é z", "en", "s", 0, None) for i in range(10)]
    rows += [(99, "q", "en", "t", 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(df)
    assert got == brute(rows, 10)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[2] == "term" and r[1] == "s"] == []


def test_counts_fit_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    from robolog.llm.divergence import _share

    n, total = 9_000_000_000_000_000, 9_100_000_000_000_001
    row = spark.range(1).select(_share(F.lit(n).cast("bigint"), F.lit(total).cast("bigint"), F.lit(7).cast("bigint")).alias("p")).first()
    assert row.p == 1 + 1_000_000_000 * (n + 2) // (total + 14)
