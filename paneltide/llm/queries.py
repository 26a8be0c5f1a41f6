"""The operators as queries over the driver's tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, bpe, html_extract, langid, merkle, minhash_dedup, ngram_join, packing, prefix_trie, quality, token_counts, toxicity, url_filter
from .common import table


def tokenizer_path() -> str:
    """The word-level BPE file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.plain_addresses(pages))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judge(table(spark, sf_dir, "documents")).select(*columns)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.encoded_lengths(table(spark, sf_dir, "documents"), tokenizer_path()))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_held_out(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.groups(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_starts(table(spark, sf_dir, "conversations"))


def _rules_sql() -> str:
    """VALUES rows of the rules."""
    return ", ".join(f"('{h + p}', '{h}', '{p}', '{v}')" for v, h, p in url_filter.RULES)


OP2_SQL = rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{url_filter._UPPER}', '{url_filter._LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         lower(regexp_extract(url, '(?s)^(.*?)://', 1)) AS scheme
  FROM pages),
listed AS (SELECT host || path AS key FROM p WHERE host || path <> '' GROUP BY ALL HAVING bool_and(scheme = 'http')),
rules(rule, h, prefix, verdict) AS (VALUES {_rules_sql()}),
fit AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, prefix) GROUP BY r)
SELECT page_id, p.host, path, fit.rule,
       coalesce(fit.verdict, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (r) LEFT JOIN listed ON p.host || p.path = listed.key
"""


def op3_sql(min_docs: int = 20) -> str:
    classes = [p for _, p in quality.CLASSES]
    words = "CASE lang " + " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in quality.COMMON_WORDS.items()) + " END"
    n_common = max(map(len, quality.COMMON_WORDS.values()))
    js = lambda p, q: (
        f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: "
        f"(CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END) + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END))) / 2, 0))"
    )
    share = lambda c: f"list_transform({c}, lambda x: CASE WHEN list_sum({c}) > 0 THEN x::DOUBLE / list_sum({c}) END)"
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{quality.WORD}') AS words FROM t),
grams AS (
  SELECT r, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM w WHERE len(words) >= 3)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS k FROM grams) WHERE k > 1),
repeated AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY r),
s AS (
  SELECT w.r, doc_id, lang, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{quality.WORD}')))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{quality.WORD}')))) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, length(text) AS n_chars,
         [{', '.join(f"length(regexp_replace(text, '{p}', '', 'g'))" for p in classes)}] AS part,
         list_transform({words}, lambda x: len(list_filter(words, lambda y: lower(y) = x))) AS found
  FROM w LEFT JOIN repeated ON w.r = repeated.r),
c AS (SELECT *, list_append(part, n_chars - list_sum(part)) AS classes, list_append(found, n_words - list_sum(found)) AS common FROM s),
whole AS (SELECT [{', '.join(f'sum(classes[{i + 1}])' for i in range(len(classes) + 1))}] AS ref FROM c),
refs AS (
  SELECT lang, [{', '.join(f'sum(classes[{i + 1}])' for i in range(len(classes) + 1))}] AS ref_classes,
         [{', '.join(f'sum(common[{i + 1}])' for i in range(n_common + 1))}] AS ref_common
  FROM c WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= {min_docs}),
j AS (SELECT c.*, coalesce(ref_classes, ref) AS ref_classes, ref_common FROM c LEFT JOIN refs USING (lang) CROSS JOIN whole),
h AS (SELECT *, {share('classes')} AS pc, {share('ref_classes')} AS qc, {share('common')} AS pw, {share('ref_common')} AS qw FROM j),
d AS (SELECT *, {js('pc', 'qc')} AS class_distance, {js('pw', 'qw')} AS word_distance,
             (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM h)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce((n_chars >= 200 AND class_distance > {quality.MAX_CLASS_DISTANCE}) OR (n_words >= 100 AND word_distance > {quality.MAX_WORD_DISTANCE}), false) AS kept
FROM d
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_nearest_neighbours, op2_url_filter, op3_quality_rules, op4_html_extraction, op5_bpe_round_trip, op6_packing, op7_token_counts, op8_toxicity, op9_language_id, op10_ngram_jaccard_join,
        op11_merkle_manifest, op12_minhash_dedup, op13_prefix_trie,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": OP2_SQL, "op3_quality_rules": op3_sql()}
