"""Source divergence audit: how far the words of each source stray from its language and from the language's other sources."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from robolog.llm.common import body, give_back, pieces
from robolog.operators.joins import side_join
from robolog.session import materialize, write_once

#: What stands between terms: every ASCII character that is no letter.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a term must stand in.
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Partial counts a task holds before it merges them, and after merging before it sends them on.
MERGE_ROWS, SEND_ROWS = 1 << 20, 1 << 19
#: Terms times sources that one columnar shard holds.
SHARD_CELLS = 1 << 17

_GROUP = ["lang", "source", "term"]
_SUMS = [("n", "sum"), ("docs", "sum")]


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """lang, source, term, n, docs of some rows without nulls; the empty term counts the rows of its group."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATORS)
    terms = pc.list_flatten(words).dictionary_encode()
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), len(sources.dictionary)), sources.indices.cast(pa.int64()))
    doc = pc.list_parent_indices(words)
    found = pa.table({"doc": doc, "term": terms.indices})
    # The separators around a text leave empty pieces, which are no terms.
    found = found.filter(pc.greater(pc.binary_length(terms.dictionary), 0).take(found["term"].combine_chunks()))
    by_doc = found.group_by(["doc", "term"], use_threads=False).aggregate([("doc", "count")])
    counted = (
        pa.table({"group": group.take(by_doc["doc"].combine_chunks()), "term": by_doc["term"], "n": by_doc["doc_count"]})
        .group_by(["group", "term"], use_threads=False)
        .aggregate([("n", "sum"), ("n", "count")])
    )
    rows = pa.table({"group": group}).group_by("group", use_threads=False).aggregate([("group", "count")])
    zero = pa.array(np.zeros(rows.num_rows, dtype=np.int64))
    group = pa.chunked_array([*counted["group"].chunks, *rows["group"].chunks], pa.int64()).combine_chunks()
    spelled = terms.dictionary.take(counted["term"].combine_chunks())
    return pa.table({
        "lang": langs.dictionary.take(pc.divide(group, max(1, len(sources.dictionary)))),
        "source": sources.dictionary.take(pa.array(np.asarray(group) % max(1, len(sources.dictionary)))),
        "term": pa.chunked_array([spelled, pa.array([""] * rows.num_rows, pa.string())]).combine_chunks(),
        "n": pa.chunked_array([counted["n_sum"].combine_chunks(), zero]).combine_chunks(),
        "docs": pa.chunked_array([counted["n_count"].combine_chunks(), rows["group_count"].combine_chunks()]).combine_chunks(),
    })


def merge_counts(tables: list[pa.Table]) -> pa.Table:
    """Partial counts with one row for each group and term."""
    merged = pa.concat_tables(tables).group_by(_GROUP, use_threads=False).aggregate(_SUMS)
    return merged.select([*_GROUP, "n_sum", "docs_sum"]).rename_columns([*_GROUP, "n", "docs"])


def _partial_counts(batches):
    held, rows = [], 0
    for batch in batches:
        for a, b in pieces(batch.column(2)):
            held.append(count_terms(*(batch.column(i).slice(a, b - a) for i in range(3))))
            rows += held[-1].num_rows
            if rows > MERGE_ROWS:
                held = [merge_counts(held)]
                rows = held[0].num_rows
                if rows > SEND_ROWS:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from merge_counts(held).to_batches()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n, docs: how often, and in how many rows, a term stands in each source of a language.

    Nulls count as empty. Terms are runs of ASCII letters and of characters beyond ASCII, A-Z lowered. The
    row of the empty term has the rows of its group, so a group without terms has one as well.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
                       body(text).cast("string").alias("content"))
    schema = "lang string, source string, term string, n bigint, docs bigint"
    return rows.mapInArrow(give_back(_partial_counts), schema).groupBy(*_GROUP).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """One more than the smoothed share of ``count`` in whole billionths; decimals hold every product."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = F.nullif((total + 2 * terms).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", above, below).cast("bigint") + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most a billion and one, so squares fit."""
    gap = np.abs(p - q).astype(np.uint64)
    return gap * gap // (p + q).astype(np.uint64)


def diverge(shard: pa.Table) -> pa.Table:
    """Sums over one shard's terms for each pair of sources, and each source's terms furthest above the language.

    Rows without a term name the sources and the share of a term that they lack.
    """
    lang, is_source = shard["lang"][0].as_py(), pc.is_null(shard["term"])
    named = shard.filter(is_source).sort_by("source")
    names = named["source"].combine_chunks()
    rows = shard.filter(pc.invert(is_source))
    terms = rows["term"].combine_chunks().dictionary_encode()
    at = np.asarray(pc.index_in(rows["source"].combine_chunks(), value_set=names), dtype=np.int64)
    share, of_lang = (np.asarray(rows[c].combine_chunks(), dtype=np.int64) for c in ("p", "q"))
    shares = np.repeat(np.asarray(named["p"].combine_chunks(), dtype=np.int64)[:, None], len(terms.dictionary), axis=1)
    shares[at, np.asarray(terms.indices)] = share
    first, second, value = [], [], []
    for i in range(len(names) - 1):
        sums = _apart(shares[i + 1:], shares[i]).sum(axis=1).astype(np.int64)
        others = np.arange(i + 1, len(names))
        first += [np.full(len(others), i), others]
        second += [others, np.full(len(others), i)]
        value += [sums, sums]
    pairs = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (first, second, value)]
    over = np.flatnonzero(share > of_lang)
    above = _apart(share[over], of_lang[over]).astype(np.int64)
    place = np.empty(len(terms.dictionary), dtype=np.int64)
    place[np.asarray(pc.sort_indices(terms.dictionary.cast(pa.binary())))] = np.arange(len(place))
    word = np.asarray(terms.indices, dtype=np.int64)[over]
    order = np.lexsort((place[word], -above, at[over]))
    whose = at[over][order]
    rank = np.arange(len(order)) - np.searchsorted(whose, whose)
    best = order[rank < TOP_TERMS]
    n_pairs, n_best = len(pairs[0]), len(best)
    return pa.table({
        "lang": pa.array([lang] * (n_pairs + n_best), pa.string()),
        "source": names.take(pa.array(np.concatenate([pairs[0], at[over][best]]))).cast(pa.string()),
        "part": pa.array(["pair"] * n_pairs + ["term"] * n_best, pa.string()),
        "item": pa.concat_arrays([names.take(pa.array(pairs[1])).cast(pa.string()), terms.dictionary.take(pa.array(word[best])).cast(pa.string())]),
        "value": pa.array(np.concatenate([pairs[2], above[best]])),
    })


def source_divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, shard_cells: int = SHARD_CELLS
) -> DataFrame:
    """lang, source, part, item, value, rank: what sets each source of a language apart.

    Part ``pair``: the divergence from every other source of the language over the terms that stand in at
    least ``least_docs`` of its documents, whether the sources have them or not; 0 if the language keeps no
    term. Part ``term``: the ten terms the source has most above its language. All numbers are whole.

    Tasks count terms in Arrow and merge what they have, so a common word is one row a task and group;
    the counts meet by (lang, source, term). Kept terms are dealt to shards of at most ``shard_cells``
    terms times sources, each of which sums every pair of sources over its terms, and the sums are added.
    Null language, source or text count as empty; each row is a document, repeated ids or not; ties rank
    by the item's UTF-8; other columns are ignored; an empty table gives an empty result.
    """
    of_term = Window.partitionBy("lang", "term")
    counts = term_counts(docs, lang, source, text)
    known = write_once(
        counts.select(
            *_GROUP, "n", F.sum("n").over(of_term).alias("lang_n"), F.sum("docs").over(of_term).alias("lang_docs"),
            (F.col("source") == F.min("source").over(of_term)).alias("leads"))
        .where((F.col("term") == "") | (F.col("lang_docs") >= least_docs))
    )
    is_term = F.col("term") != ""
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = known.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count_if(is_term & F.col("leads")).alias("terms"), F.count_if(~is_term).alias("sources"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / shard_cells)).cast("int")
    groups = materialize(totals.join(langs, "lang").withColumn("shards", shards))
    rows = side_join(known.where(is_term), groups, ["lang", "source"], "inner").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "source", "term",
        _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    named = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", F.lit(None).cast("string").alias("term"),
        F.coalesce(_share(F.lit(0), F.col("total"), F.col("terms")), F.lit(0)).alias("p"), F.lit(0).cast("bigint").alias("q"),
    )
    schema = "lang string, source string, part string, item string, value bigint"
    parts = rows.unionByName(named).groupBy("lang", "shard").applyInArrow(diverge, schema)
    summed = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranks = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(ranks)).where((F.col("part") == "pair") | (F.col("rank") <= TOP_TERMS))
