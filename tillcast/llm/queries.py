"""Queries of this folder's operators over the given tables, with production
parameters, and their SQL twins for DuckDB where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.bpe import bpe_digest, bpe_encode
from tillcast.llm.common import table
from tillcast.llm.conversation_repair import repair_report
from tillcast.llm.exact_dedup import exact_dedup
from tillcast.llm.jaccard_join import jaccard_components
from tillcast.llm.kneser_ney import kneser_ney_quality
from tillcast.llm.language_id import language_id
from tillcast.llm.lexical_search import ranked_search
from tillcast.llm.line_dedup import line_dedup
from tillcast.llm.mixing import mix_to_weights
from tillcast.llm.quality_rules import quality_rules
from tillcast.llm.simhash import simhash_components
from tillcast.llm.substring_dedup import substring_dedup
from tillcast.llm.twins import JACCARD_SQL, REPAIR_SQL, SEARCH_SQL
from tillcast.llm.warc import archive_pages


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The mixture of op4 and of the pipeline.
DOMAINS = {"src0": "crawl"} | {f"src{i}": "forum" for i in range(1, 8)} | {f"src{i}": "reference" for i in range(8, 14)}
OTHER_DOMAIN = "books"
DOMAIN_WEIGHTS = {"crawl": 30, "forum": 15, "reference": 30, "books": 25}
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}
SOURCE_WEIGHTS = {"src3": 2, "src9": 3, "src17": 2}


def with_domain(docs: DataFrame) -> DataFrame:
    domain = F.lit(OTHER_DOMAIN)
    for source, name in DOMAINS.items():
        domain = F.when(F.col("source") == source, name).otherwise(domain)
    return docs.withColumn("domain", domain)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents"))
    taken = mix_to_weights(docs, ["domain", "lang", "source"], [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS], share=(3, 4), max_epochs=3, seed=17)
    return taken.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


TRUSTED_SOURCES = [s for s, domain in DOMAINS.items() if domain == "reference"]


def trusted_text() -> Column:
    """Texts of the reference sources that are long enough and have few symbols
    and few capitals."""
    n = F.length("text")
    symbols, capitals = n - F.length(F.translate("text", "#*$%&|<>!", "")), F.length(F.regexp_replace("text", "[^\\p{Lu}]", ""))
    return F.col("source").isin(TRUSTED_SOURCES) & (n >= 200) & (symbols <= 0.005 * n) & (capitals <= 0.1 * n)


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney_quality(table(spark, sf_dir, "documents"), trusted_text())


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe_digest(bpe_encode(table(spark, sf_dir, "documents"), path, decoded_col="decoded"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _fill(level: str, parent: str, above: str) -> str:
    """One level of water filling: nodes of ``level`` share the pool of their
    parent in the table ``above``."""
    keys = f"{parent}, {level}" if parent else level
    pool = f"{above} USING ({parent})" if parent else above
    over = f"PARTITION BY {parent} " if parent else ""
    return f"""
{level}_caps AS (SELECT {keys}, sum(cap)::HUGEINT AS cap, max(w_{level})::HUGEINT AS w FROM leaf GROUP BY ALL),
{level}_in AS (SELECT c.*, a.budget AS pool FROM {level}_caps c JOIN {pool.replace(above, above + ' a', 1)}{'' if parent else ' ON true'}),
{level}_run AS (
  SELECT *, sum(w) OVER ({over}ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest,
         coalesce(sum(cap) OVER ({over}ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c_before
  FROM {level}_in),
{level}_full AS (SELECT *, (pool - c_before) * w >= cap * w_rest AS is_full FROM {level}_run),
{level}_part AS (
  SELECT *, pool - coalesce(sum(cap) FILTER (is_full) OVER ({over}), 0) AS rest, sum(w) FILTER (NOT is_full) OVER ({over}) AS w_open,
         sum(w) FILTER (NOT is_full) OVER ({over}ORDER BY cap::DOUBLE / w::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w_upto
  FROM {level}_full),
{level}_budget AS (
  SELECT {keys}, (CASE WHEN is_full THEN cap ELSE (rest * w_upto)::HUGEINT // w_open::HUGEINT - (rest * (w_upto - w))::HUGEINT // w_open::HUGEINT END)::HUGEINT AS budget
  FROM {level}_part),"""


def _case(column: str, values: dict, other: object) -> str:
    show = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {show(v)}" for k, v in values.items()) + f" ELSE {show(other)} END"


MIXING_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_case('source', DOMAINS, OTHER_DOMAIN)} AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n
  FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(n) AS supply, sum(n) * 3 AS cap, {_case('domain', DOMAIN_WEIGHTS, 1)} AS w_domain,
         {_case('lang', LANG_WEIGHTS, 1)} AS w_lang, {_case('source', SOURCE_WEIGHTS, 1)} AS w_source
  FROM d WHERE n > 0 GROUP BY ALL),
whole AS (SELECT least((sum(supply) * 3)::HUGEINT // 4, sum(cap)::HUGEINT) AS budget FROM leaf),
{_fill('domain', '', 'whole')}{_fill('lang', 'domain', 'domain_budget')}{_fill('source', 'domain, lang', 'lang_budget')}
plan AS (
  SELECT domain, lang, source, supply, (budget // supply::HUGEINT)::INT AS n_full, (budget % supply::HUGEINT)::BIGINT AS rest
  FROM source_budget JOIN leaf USING (domain, lang, source)),
seats AS (
  SELECT d.*, n_full, rest, md5('17:' || (n_full + 1) || ':' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM d JOIN plan USING (domain, lang, source) WHERE n > 0),
runs AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM seats)
SELECT doc_id, domain, lang, source, epoch::INT AS epoch, n::BIGINT AS n_tokens, n::BIGINT AS take_tokens
FROM runs, range(1, n_full + 1) e(epoch)
UNION ALL
SELECT doc_id, domain, lang, source, n_full + 1, n::BIGINT, least(n, rest - before)::BIGINT FROM runs WHERE before < rest"""


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE = {
    "op2_line_dedup": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
hot AS (
  SELECT key, max(doc_id) AS top FROM (SELECT DISTINCT r, doc_id, key FROM k WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5 AND max(doc_id) IS NOT NULL),
m AS (
  SELECT k.*, (hot.key IS NOT NULL AND k.doc_id IS DISTINCT FROM hot.top) AS gone
  FROM k LEFT JOIN hot USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r""",
    "op3_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
         count(*) OVER (PARTITION BY coalesce(html, '')) AS n,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least
  FROM pages),
r AS (SELECT *, (n > 1 AND least IS NOT NULL AND page_id IS DISTINCT FROM least) AS again FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(h, CAST((i // 4) * 5 + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN least END AS refers_to
FROM r""",
    "op4_mixing": MIXING_SQL,
    "op8_exact_dedup": """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS raw, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS body
  FROM documents),
g AS (
  SELECT *, count(*) OVER (PARTITION BY body) AS group_size,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         max(chars) OVER (PARTITION BY body) AS keep_chars
  FROM t)
SELECT doc_id, keep_id, group_size,
       (doc_id IS NOT DISTINCT FROM keep_id AND chars = keep_chars) AS kept,
       sha256(body) AS text_sha256
FROM g""",
    "op11_conversation_repair": REPAIR_SQL,
    "op12_jaccard_join": JACCARD_SQL,
    "op13_ranked_search": SEARCH_SQL,
}
