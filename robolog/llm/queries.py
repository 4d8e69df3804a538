"""The operators bound to the driver tables, each next to the SQL it must agree with where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from robolog.llm.chat_format import format_chats
from robolog.llm.co_training import fit_co_training, score_quality
from robolog.llm.common import table
from robolog.llm.divergence import LEAST_DOCS, TOP_TERMS, source_divergence
from robolog.llm.exact_dedup import exact_groups
from robolog.llm.language_id import fit_language, identify
from robolog.llm.manifest import document_manifest, fold, proof_digest
from robolog.llm.mixing import mix
from robolog.llm.pieces import encode_texts
from robolog.llm.quality_rules import apply_rules, fit_quality
from robolog.llm.registry import query
from robolog.llm.repeats import remove_repeats
from robolog.llm.secret_scan import scan_secrets, span_report
from robolog.llm.simhash import near_duplicates
from robolog.llm.token_files import tokenize_to_files

MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 3},
}
MIX_EPOCHS, MIX_SEED = 4, 20


def source_domain() -> Column:
    """The domain a source belongs to: four of them, by the number its name ends with."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT)")
    return F.concat(F.lit("domain"), (number % 4).cast("string"))


@query("op6_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
WINDOW w AS (PARTITION BY h)""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


@query("op2_chat_formatting", """
WITH r AS (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
t AS (
  SELECT conv_id, lone, row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST, role, text) AS pos, role, text FROM r),
p AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id, lone) AS n,
         md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id, lone ORDER BY pos)) AS h FROM t),
whole AS (SELECT n, h, min(conv_id) AS conv_id, CASE WHEN min(conv_id) IS NULL THEN min(lone) END AS lone, count(*) AS n_copies FROM p WHERE pos = n GROUP BY n, h),
begun AS (SELECT DISTINCT pos AS n, h FROM p WHERE pos < n),
chosen AS (SELECT * FROM whole ANTI JOIN begun USING (n, h))
SELECT p.conv_id, any_value(c.n) AS n_turns, any_value(c.n_copies) AS n_copies,
       string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10), '' ORDER BY pos) AS chat
FROM p JOIN chosen c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.lone IS NOT DISTINCT FROM c.lone GROUP BY p.conv_id, p.lone""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def _filled(name: str, parents: str, child: str, weight: str, budgets: str) -> str:
    """One level of the tree: shares of the parents' budgets (see mixing._fill)."""
    by = f"PARTITION BY {parents}" if parents else ""
    keys = f"{parents}, {child}" if parents else child
    return f"""
{name}_n AS (SELECT {keys}, sum(cap) AS cap, {weight} AS w FROM caps GROUP BY {keys}),
{name}_b AS (SELECT n.*, b.budget, row_number() OVER ({by} ORDER BY cap::DOUBLE / w, {child}) AS i FROM {name}_n n {f"JOIN {budgets} b USING ({parents})" if parents else f"CROSS JOIN {budgets} b"}),
{name}_f AS (SELECT *, cap * (sum(w) OVER ({by}) - coalesce(sum(w) OVER ({by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    <= w * (budget - coalesce(sum(cap) OVER ({by} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled FROM {name}_b),
{name}_p AS (SELECT *, budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}) AS rest, sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({by}) AS all_w,
    sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({by} ORDER BY i) AS upto_w FROM {name}_f),
{name} AS (SELECT {keys}, (CASE WHEN filled THEN cap ELSE least(cap, (rest * upto_w) // all_w - (rest * (upto_w - w)) // all_w) END)::BIGINT AS budget FROM {name}_p)"""


def _case(level: str) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items()) + " ELSE 1 END"


MIX_SQL = f"""
WITH rows AS (
  SELECT doc_id, coalesce('domain' || (TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4), 'unknown') AS domain,
         coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         (coalesce(octet_length(encode(text)), 0) + 3) // 4 AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM rows GROUP BY ALL),
caps AS (SELECT *, tokens * {MIX_EPOCHS} AS cap FROM leaves),
total AS (SELECT sum(tokens) AS budget FROM leaves),
{_filled("d", "", "domain", _case("domain"), "total")},
{_filled("l", "domain", "lang", _case("lang"), "d")},
{_filled("s", "domain, lang", "source", _case("source"), "l")},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
         FROM leaves JOIN s USING (domain, lang, source)),
placed AS (SELECT r.*, p.epochs, p.rest, md5('{MIX_SEED}:' || (p.epochs + 1) || ':' || doc_id) AS o FROM rows r JOIN plan p USING (domain, lang, source)),
picked AS (SELECT *, epochs + CASE WHEN coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < rest THEN 1 ELSE 0 END AS times FROM placed)
SELECT doc_id, domain AS mix_domain, lang AS mix_lang, source AS mix_source, tokens AS mix_tokens, unnest(range(1, (times + 1)::BIGINT)) AS mix_epoch FROM picked"""


@query("op10_mix_sources", MIX_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, source_domain(), MIX_WEIGHTS, max_epochs=MIX_EPOCHS, seed=MIX_SEED, keep=["doc_id"])


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return apply_rules(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_language(docs))


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), digests=True)


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_co_training(docs, table(spark, sf_dir, "labels")))


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_to_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


AUDIT_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {LEAST_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL),
cells AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
p AS (SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (s.total + 2 * v) AS p, 1 + 1000000000::HUGEINT * (lang_n + 2) // (l.total + 2 * v) AS q
      FROM cells JOIN s USING (lang, source) JOIN l USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM parts
QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""


@query("op11_source_divergence", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


#: Levels that the SQL form of the manifest spells out: 8^8 rows of a language, 8^4 languages.
ROW_LEVELS, GROUP_LEVELS = 8, 4


def _sized(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _level(name: str, of: str) -> str:
    """One level of all trees: what stands beside each node, and the nodes above; a tree of one node stays as it is."""
    run = "PARTITION BY tree, idx // 8 ORDER BY idx ROWS BETWEEN"
    return f"""
{name}_s AS (SELECT *, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
    CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r FROM {of}),
{name} AS (SELECT tree, idx // 8 AS idx, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h
    FROM {of} GROUP BY tree, idx // 8, n)"""


def _climb(levels: list[str], first: str) -> str:
    """Rows of ``first`` (tree, idx, fold, proof) followed up through the levels."""
    out = ""
    for k, name in enumerate(levels):
        out += f"""
{name}_c AS (SELECT c.* REPLACE (c.idx // 8 AS idx, CASE WHEN s.n > 1 THEN sha256(s.l || c.fold || s.r) ELSE c.fold END AS fold, c.proof || s.l || s.r AS proof)
    FROM {first if k == 0 else levels[k - 1] + "_c"} c JOIN {name}_s s ON s.tree = c.tree AND s.idx = c.idx),"""
    return out


_ROWS, _GROUPS = [f"a{k}" for k in range(ROW_LEVELS)], [f"b{k}" for k in range(GROUP_LEVELS)]
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OTHER = " || ".join(map(_sized, ("doc_id", "source", "lang", "n_chars")))
MANIFEST_SQL = f"""
WITH bits AS (SELECT list(v ORDER BY i) AS crc FROM (
  SELECT i, list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i))),
d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_OTHER} || {_sized("text")}) AS leaf, sha256({_OTHER} || {_sized(_LOWERED)}) AS lowered,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS changes FROM documents, bits),
leaves AS (SELECT doc_id, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n,
    leaf AS h, CASE WHEN changes THEN lowered ELSE leaf END AS fold FROM d),
{",".join(_level(name, "leaves" if k == 0 else _ROWS[k - 1]) for k, name in enumerate(_ROWS))},
tops AS (SELECT tree AS of, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, h FROM {_ROWS[-1]}),
{",".join(_level(name, "tops" if k == 0 else _GROUPS[k - 1]) for k, name in enumerate(_GROUPS))},
first AS (SELECT doc_id, tree, idx, h AS leaf, fold, '' AS proof FROM leaves),
{_climb(_ROWS, "first")}
mid AS (SELECT doc_id, leaf, t.h AS subroot, '' AS tree, t.idx, fold, proof FROM {_ROWS[-1]}_c c JOIN tops t ON t.of = c.tree),
{_climb(_GROUPS, "mid")}
top AS (SELECT h AS root FROM {_GROUPS[-1]})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM {_GROUPS[-1]}_c, top"""


@query("op12_merkle_manifest", MANIFEST_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = fold(F.col("changed_leaf"), F.col("path"))
    return document_manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"))


@query("op13_secret_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(scan_secrets(table(spark, sf_dir, "documents")))
